"""Operators that SQL can express against that SQL, on odd rows too."""

import duckdb
import pytest

from tidemark.llm import mixing, quality_rules, secrets, sql
from tidemark.llm.common import written

from .test_text_ops import docs  # noqa: F401

RUN = {"op3_weighted_fair_mix": mixing.mix, "op6_ownership_secrets": secrets.scan, "op8_rule_cascade": quality_rules.judge}


@pytest.mark.parametrize("name", sorted(RUN))
def test_equals_sql(spark, docs, name, tmp_path):  # noqa: F811
    path = str(tmp_path / "documents.parquet")
    docs.select("doc_id", "text", "lang", "source", "n_chars").coalesce(1).write.parquet(path)
    c = duckdb.connect()
    c.sql(f"create view documents as select * from '{path}/*.parquet'")
    want = c.sql(sql.ORACLES[name])
    got = written(RUN[name](docs))
    assert sorted(got.columns) == sorted(want.columns)
    cols = list(want.columns)
    assert sorted((tuple(r[x] for x in cols) for r in got.collect()), key=str) == sorted(want.fetchall(), key=str)
