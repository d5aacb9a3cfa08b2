"""Labels of other types than whole numbers."""

import pytest

from featureflow.llm.common import Cuts
from featureflow.llm.embed_dedup import near_vectors


@pytest.mark.parametrize("kind, labels", [
    ("string", ["a", "a ", "a", None, "", ""]), ("double", [1.2, 1.7, 1.2, None, 0.0, -0.0]),
    ("decimal(5,2)", [1.2, 1.7, 1.2, None, 0, 0]), ("boolean", [True, False, True, None, False, False])])
def test_labels_are_compared_as_they_are(spark, kind, labels):
    from decimal import Decimal

    same = [1.0, 2.0, 3.0]
    rows = [(10 + i, Decimal(str(x)) if kind.startswith("dec") and x is not None else x, same) for i, x in enumerate(labels)]
    rows.append((30, rows[0][1], [-1.0, 0.0, 0.0]))
    rows.append((31, rows[0][1], [1.0, 2.0, 3.01]))
    df = spark.createDataFrame(rows, f"vec_id long, label {kind}, embedding array<double>")
    with Cuts(spark) as cuts:
        got = {r.id: r for r in near_vectors(df, cuts).collect()}
    want = {i: sorted(j for j, x, v in rows if j != i and x is not None and x == y and v != [-1.0, 0.0, 0.0])
            for i, y, _ in rows}
    want[30] = []
    assert {i: r.n_links for i, r in got.items()} == {i: len(v) for i, v in want.items()}
    assert {i: r.component_id for i, r in got.items()} == {i: min([i, *v]) for i, v in want.items()}
