"""Values and frames that several test modules share."""

import pandas as pd

SMALL = "/root/testdata/sf0.001"
PROCESSED_SCHEMA = "row_id long, userId long, movieId long, rating double, timestamp long, genres string"


def random_processed(spark, rows=300, users=10, items=20, seed=7):
    """Seeded random processed ratings, as (Spark frame, pandas frame)."""
    import numpy as np

    rng = np.random.default_rng(seed)
    texts = ["Action|Adventure", "Comedy|Drama", "Action", "Drama", "Sci-Fi|Action"]
    movie = rng.integers(1, items + 1, rows)
    frame = pd.DataFrame(
        {
            "row_id": range(rows),
            "userId": rng.integers(1, users + 1, rows),
            "movieId": movie,
            "rating": rng.uniform(1, 5, rows).round(1),
            "timestamp": rng.integers(964982703, 978307200, rows),
            "genres": [texts[m % len(texts)] for m in movie],
        }
    )
    return spark.createDataFrame(frame, PROCESSED_SCHEMA), frame
