import inspect
import re

import corpus_pipeline
import pytest
from helpers import documents, least_reachable, prose, shingles, similar
from pyspark.sql import functions as F

import __spark_entry__
from stagelight.llm import bpe
from stagelight.llm.queries import queries


def corpus(rng):
    """Texts of each kind, and which of them stay."""
    item = prose(rng, 30, 10**6)
    clean = [prose(rng, rng.randrange(30, 90), 5000) for _ in range(60)]
    toxic = [f"{prose(rng, 40, 5000)} gruxen {prose(rng, 10, 5000)} gruxa gruxix" for _ in range(20)]
    leaks = [f"{prose(rng, 40, 5000)} {item} {prose(rng, 40, 5000)}" for _ in range(4)]
    copies = [clean[0], clean[0].replace(" ", "  "), clean[1] + " more", clean[2].upper()]
    return clean + toxic + leaks + copies + [None, "", "  "], item


def write(spark, rng, tmp_path):
    texts, item = corpus(rng)
    documents(spark, texts, clashing=("score", "hits")).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(k, 1, int("grux" in (t or ""))) for k, t in enumerate(texts)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return texts, item


def brute(texts, item):
    """The ids that all stages keep, by plain Python; toxic texts are known by their words."""
    left = {k: t for k, t in enumerate(texts) if "grux" not in (t or "")}
    groups = {}
    for k, t in left.items():
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append(k)
    left = {k: left[k] for k in (min(g, key=lambda k: (-len(left[k] or ""), k)) for g in groups.values())}
    sets = {k: shingles(t) for k, t in left.items()}
    least = least_reachable(sorted(left), lambda a, b: similar(sets[a], sets[b]))
    return {k for k in left if least[k] == k and item not in (left[k] or "")}


def test_run_as_brute_force(spark, rng, tmp_path):
    texts, item = write(spark, rng, tmp_path)
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in rows} == brute(texts, item) and len(rows) == len({r["doc_id"] for r in rows})
    with open(bpe.public_ranks()[0], "rb") as file:
        own = bpe.Encoder(file.read(), bpe.public_ranks()[1])
    assert all(r["n_tokens"] == len(own.encode([texts[r["doc_id"]] or ""])[0]) // 4 for r in rows)


def test_stages_return_the_columns_of_documents(spark, rng, tmp_path):
    write(spark, rng, tmp_path)
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    left = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert list(inspect.signature(stage).parameters) == ["spark", "docs", "sf_dir"]
        after = stage(spark, docs, str(tmp_path))
        assert after.schema.names == docs.schema.names, name
        assert after.count() < left, name
        left, docs = after.count(), spark.createDataFrame(after.collect(), docs.schema)


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_on_an_empty_table(spark, rng, tmp_path, name):
    write(spark, rng, tmp_path)
    docs = spark.read.parquet(str(tmp_path / "documents.parquet")).where(F.lit(False))
    assert dict(corpus_pipeline.STAGES)[name](spark, docs, str(tmp_path)).collect() == []


def test_one_query_for_each_operator():
    names = __spark_entry__.queries()
    assert all(sum(bool(re.match(rf"op{n}_", name)) for name in names) == 1 for n in range(1, 11))
    assert set(queries()) < set(names) and "pipeline" in names
