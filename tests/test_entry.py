"""The queries against their SQL on the smallest tables, and the entry point without the optional subpackage."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from folioscope import catalogue

ROOT, SF = Path(__file__).resolve().parent.parent, "/root/testdata/sf0.001"
QUICK = "term_stats paper_topics topic_stats topic_cooccurrence keyword_seeds gap_seeds metadata_merge section_tree rule_filtered_sections claim_limits registry_state stage_funnel event_envelope table_render".split()


def value(v):
    return round(float(v), 6) if isinstance(v, float) or type(v).__name__ == "Decimal" else str(v)


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, name):
    c = duckdb.connect()
    for t in "part documents benchmark labels pages orders lineitem events conversations".split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = catalogue.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    found = c.execute(catalogue.ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == cols
    want = sorted(str([value(r[names.index(k)]) for k in cols]) for r in found.fetchall())
    assert sorted(str([value(x) for x in r]) for r in df.select(*cols).collect()) == want


def test_entry_without_llm(tmp_path):
    code = "import sys; sys.modules['folioscope.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; q = e.queries(); assert 'term_stats' in q and 'pipeline' not in q and not any(k.startswith('op1') for k in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
