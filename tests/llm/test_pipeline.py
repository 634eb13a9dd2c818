"""The pipeline, stage by stage, against plain versions on the smallest test data, and the registration of all queries."""

import re
import shutil
import subprocess
import sys
from collections import defaultdict
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_ngram_join import shingles
from test_packing import check

import __spark_entry__ as contract
import corpus_pipeline
from cartwheel.llm import exact_dedup, quality
from cartwheel.llm.queries import ORACLES, QUERIES
from cartwheel.llm.tables import saved, small_batches, table

ROOT = Path(corpus_pipeline.__file__).parent
FOLD = str.maketrans(exact_dedup.UPPER, exact_dedup.LOWER)


@pytest.fixture(scope="module")
def written(spark, sf_dir):
    """What each stage was given and what it returned."""
    docs, out = table(spark, sf_dir, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        out[name] = docs, (docs := saved(stage(spark, docs, sf_dir), "stage"))
    return out


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "n-gram Jaccard join", "PII", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_quality_stage(spark, sf_dir, written):
    before, after = written["quality classifier"]
    model = quality.quality_model(spark, before, sf_dir)
    given = before.collect()
    scores = model.score(pa.array([row.text for row in given]))
    tails = model.tails(scores)
    assert rows(after) == sorted(tuple(row) for row, score, tail in zip(given, scores, tails) if tail[-1] >= quality.KEEP or score >= 0)
    assert 0.6 * len(given) < after.count()  # so few labels prove little, and then nearly all stay
    assert after.columns == before.columns


def test_exact_stage(written):
    before, after = written["exact dedup"]
    groups = defaultdict(list)
    for row in before.collect():
        groups[row.text.translate(FOLD)].append(tuple(row))
    assert rows(after) == sorted(max(own) for own in groups.values())
    assert after.columns == before.columns


def test_near_stage(written):
    before, after = written["n-gram Jaccard join"]
    given = sorted(before.collect())
    sets = [shingles(row.text) for row in given]
    root = list(range(len(given)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(given)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    assert rows(after) == [tuple(row) for at, row in enumerate(given) if find(at) == at]
    assert after.columns == before.columns


def test_pii_stage(written):
    before, after = written["PII"]
    assert rows(after.drop("text")) == rows(before.drop("text")) and after.columns == before.columns
    text = {row.doc_id: row.text for row in before.collect()}
    changed = [row for row in after.collect() if row.text != text[row.doc_id]]
    plain = re.compile(r"[0-9]{3}|@|[0-9][ .\-][0-9]|AKIA|password=")
    assert changed and all(plain.search(text[row.doc_id]) for row in changed)
    for row in after.collect():
        for value in re.findall(r"[\w.]+@mail[0-9]+\.example\.com", text[row.doc_id]):
            assert value not in row.text


def test_packing_stage(written):
    before, after = written["packing"]
    pieces = [(r.doc_id, r.start, r.length, r.sequence_id, r.offset, r.doc_tokens) for r in after.collect()]
    tokens, room = check(pieces)
    assert room <= 1.01 * tokens and {p[0] for p in pieces} == {r.doc_id for r in before.collect()}


def test_run_is_the_stages_in_turn(spark, sf_dir, written):
    last = written["packing"][1]
    run = corpus_pipeline.run(spark, sf_dir)
    assert run.columns == last.columns
    key = ("doc_id", "start", "length", "ids", "doc_tokens")
    assert rows(run.select(*key)) == rows(last.select(*key))


def test_odd_documents_pass_all_stages(spark, sf_dir, odd_docs, no_docs):
    for docs in (odd_docs.withColumns({"doc": F.lit(1), "finds": F.lit("x"), "token": F.lit(2)}), no_docs):
        rest = saved(docs, "odd")
        columns = rest.columns
        for name, stage in corpus_pipeline.STAGES:
            if name != "packing":
                rest = saved(stage(spark, rest, sf_dir), "odd")
                assert rest.columns == columns
            else:
                rest = stage(spark, rest, sf_dir)
        assert (rest.count() == 0) == (docs is no_docs)


def test_one_query_for_each_operator():
    names = [name for name in contract.queries() if re.match(r"op\d+_", name)]
    assert sorted(int(name[2:].split("_")[0]) for name in names) == list(range(1, 11))
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def test_the_rest_works_without_the_corpus_operators(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__", ".pytest_cache"))
    code = "import __spark_entry__ as e; print(sorted(n for n in e.queries() if n.startswith(('op', 'pipeline'))), len(e.queries()) > 30)"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120)
    assert done.stdout.strip() == "['pipeline_run'] True", done.stderr


def test_stages_bound_the_batches_sent_to_python(spark, sf_dir):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["rows", "bytes"])

    for name in ("quality classifier", "n-gram Jaccard join", "packing"):
        fresh = spark.newSession()
        docs = fresh.range(2500).selectExpr("id as doc_id", "repeat(cast(id % 7 as string), 9000) as text").coalesce(1)
        dict(corpus_pipeline.STAGES)[name](fresh, docs.limit(20), sf_dir)
        found = docs.mapInArrow(sizes, "rows bigint, bytes bigint").collect()
        assert sum(row.rows for row in found) == 2500
        assert max(row.rows for row in found) <= 1000 and max(row.bytes for row in found) < 5 << 20

    own = spark.newSession()
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    small_batches(own)
    assert own.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "7"
