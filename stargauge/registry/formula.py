"""A network whose weights follow a formula, and its forward pass in SQL."""

from __future__ import annotations

import numpy as np

from ..plans.mlp import MlpRegressorModel

#: Units of the hidden layers and of the output.
FORMULA_WIDTHS = [6, 4, 1]


def formula_network(widths: list[int]) -> MlpRegressorModel:
    """Weight (i, j) of layer l is ((7 i + 11 j + 5 l) mod 13 - 6) / 20; the rest is as simple."""
    params = {}
    for layer, (fan_in, fan_out) in enumerate(zip(widths, widths[1:])):
        i, j = np.arange(fan_in)[:, None], np.arange(fan_out)
        params[f"w{layer}"] = ((7 * i + 11 * j + 5 * layer) % 13 - 6) / 20
        params[f"b{layer}"] = ((3 * j + layer) % 5 - 2) / 10 + 3.0 * (layer == len(widths) - 2)
        if layer < len(widths) - 2:
            params[f"gain{layer}"], params[f"shift{layer}"] = 1 + j % 3 / 10, (j % 4 - 1) / 10
            params[f"mean{layer}"], params[f"var{layer}"] = j % 5 / 10, 1 + j % 2 / 2
    return MlpRegressorModel(params, len(widths) - 2, [])


def forward_pass(names: list[str], source: str) -> dict[str, str]:
    """Subqueries up to ``net`` (row_id, prediction) over scaled feature columns of ``source``."""
    width = len(names)
    steps = {
        "a0": f"SELECT row_id, unnest([{', '.join(names)}]) AS x, unnest(range({width})) AS i FROM {source}"
    }
    last = len(FORMULA_WIDTHS) - 1
    for layer, units in enumerate(FORMULA_WIDTHS):
        weight = f"((7 * i + 11 * j + 5 * {layer}) % 13 - 6) / 20.0::double"
        bias = f"((3 * j + {layer}) % 5 - 2) / 10.0::double"
        total = f"(sum(x * {weight}) + {bias} + {3.0 if layer == last else 0.0}::double)"
        if layer < last:
            unit = f"({total} - (j % 5) / 10.0::double) / sqrt(1 + (j % 2) / 2.0::double + 1e-5::double)"
            total = f"greatest(0, {unit} * (1 + (j % 3) / 10.0::double) + (j % 4 - 1) / 10.0::double)"
        steps[f"a{layer + 1}"] = (
            f"SELECT row_id, j AS i, {total} AS x FROM a{layer}, (SELECT unnest(range({units})) AS j) GROUP BY row_id, j"
        )
    return steps | {"net": f"SELECT row_id, x AS prediction FROM a{last + 1}"}
