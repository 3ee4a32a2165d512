import pytest

import __spark_entry__ as E
import corpus_pipeline
from hearth.llm.queries import ORACLE, QUERIES

from conftest import SF_SMALL
from test_oracle_parity import _rows


def test_all_operators_are_registered():
    names = E.queries()
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert names["pipeline"] is corpus_pipeline.run
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    cur = duck.execute(ORACLE[name])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(cols, cur.fetchall())
