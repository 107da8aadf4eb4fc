import corpus_pipeline
import __spark_entry__ as entry
from ledgerline.llm.catalog import ORACLE_SQL, QUERIES
from ledgerline.llm.decontaminate import find_contamination
from tests.compare import compare, duck
from tests.conftest import SF_CHECK


def test_every_operator_is_registered():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert {*QUERIES, "pipeline"} <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())


def test_queries_with_sql_match_it(spark):
    con = duck(SF_CHECK)
    for name, sql in ORACLE_SQL.items():
        ok, message = compare(QUERIES[name](spark, SF_CHECK), con, sql)
        assert ok, (name, message)


def test_stages_on_real_documents(spark):
    """Each stage on its own input: its columns, and that its decision takes effect."""
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    kept = {}
    for name, step in corpus_pipeline.STAGES:
        out = step(spark, docs, SF_CHECK).cache()
        kept[name] = out.count()
        if name != "byte_bpe":
            assert out.columns == docs.columns
        docs = out
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "ngram_join", "decontamination", "byte_bpe"]
    assert 1000 > kept["toxicity"] == kept["line_dedup"] > kept["ngram_join"] > kept["decontamination"] == kept["byte_bpe"] > 500
    assert corpus_pipeline.ORACLE_SQL is None


def test_decontaminated_documents_are_clean(spark):
    docs, bench = (spark.read.parquet(f"{SF_CHECK}/{t}.parquet") for t in ("documents", "benchmark"))
    left = corpus_pipeline.decontamination(spark, docs, SF_CHECK)
    assert find_contamination(left, bench).filter("size(ranges) > 0").count() == 0
