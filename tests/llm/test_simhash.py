import random

import xxhash
from helpers import components, no_documents, odd_documents, words

from stargauge.llm.components import connected_components
from stargauge.llm.simhash import add_fingerprints, component_ids, fingerprint, link_fingerprints, simhash_components


def plain_fingerprint(text):
    w = [x.encode().lower() for x in words(text)]
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [b" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    value = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return value - (1 << 64) if value >> 63 else value


def test_fingerprint_matches_a_plain_version():
    draw = random.Random(1)
    for text in [None, "", " \n", "One", "One two", "A B c", "É é É é x"] + [
        " ".join(draw.choice("ab Cd ef É 日 x".split()) for _ in range(draw.randint(3, 60))) for _ in range(40)
    ]:
        assert fingerprint(text) == plain_fingerprint(text)


def test_long_texts_are_counted_whole(monkeypatch):
    import stargauge.llm.simhash as module

    text = " ".join(str(i * i % 977) for i in range(500))
    want = fingerprint(text)
    monkeypatch.setattr(module, "HASHES_AT_ONCE", 7)
    assert fingerprint(text) == want == plain_fingerprint(text)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def near_groups():
    draw = random.Random(3)
    found = set()
    for _ in range(12):
        x = draw.getrandbits(64)
        for _ in range(draw.randint(1, 25)):
            found.add(signed(x))
            for _ in range(draw.randint(1, 4)):
                x ^= 1 << draw.randrange(64)
    return sorted(found | {0, -1, 1})


def test_components_are_those_of_all_links(spark):
    values = near_groups()
    want = components(values, lambda x, y: ((x ^ y) & (1 << 64) - 1).bit_count() <= 3)
    fps = spark.createDataFrame([(x,) for x in values], "fp long")
    for tile in (2048, 4):
        links = link_fingerprints(fps, tile=tile)
        assert all(((r["a"] ^ r["b"]) & (1 << 64) - 1).bit_count() <= 3 for r in links.collect())
        got = {r["node"]: r["root"] for r in connected_components(links).collect()}
        assert {x: got.get(x, x) for x in values} == want


def test_a_dense_group_gives_few_links(spark):
    values = [signed(0xABCDEF << 20 | i) for i in range(256)]
    links = link_fingerprints(spark.createDataFrame([(x,) for x in values], "fp long"), tile=64)
    assert links.count() < 256 * 10 * 8
    assert connected_components(links).select("root").distinct().count() == 1


def test_component_ids_take_the_smallest_key(spark):
    prints = spark.createDataFrame([(5, 7), (3, 7), (9, 6), (1, 1 << 40), (None, 7), (None, -1)], "doc_id long, simhash long")
    got = {r["fp"]: r["component_id"] for r in component_ids(prints).collect()}
    assert got == {7: 3, 6: 3, 1 << 40: 3, -1: None} or got == {7: 1, 6: 1, 1 << 40: 1, -1: None}


def test_odd_rows_and_empty_table(spark):
    docs = odd_documents(spark)
    got = simhash_components(docs).collect()
    assert len(got) == docs.count()
    by_id = {}
    for r in got:
        by_id.setdefault(r["doc_id"], set()).add((r["fingerprint"], r["component_id"]))
    assert by_id[1] == by_id[2] == by_id[3] == {("0" * 16, 1)}
    assert by_id[5] == by_id[6] and {c for _, c in by_id[6]} == {5}
    assert add_fingerprints(docs).count() == docs.count()
    assert simhash_components(no_documents(spark)).count() == 0


def test_chain_and_star_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(41)} == {0} and {got[i] for i in range(100, 130)} == {100}
