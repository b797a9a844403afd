"""The pipeline's stages against plain versions, each on what its predecessor kept."""

from collections import Counter

from pyspark.accumulators import AccumulatorParam

import corpus_pipeline
from airgrid.llm import language, mixing, quality

from .data import documents, rows
from .test_documents import brute_components, n_words


def test_each_stage_on_its_predecessors_rows(spark, work, tmp_path, monkeypatch):
    monkeypatch.setattr(language, "TRAIN_STEPS", 120)
    folder = str(tmp_path)
    docs = documents(spark)
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(i % 6 != 5), 0) for i in range(60)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    stage = dict(corpus_pipeline.STAGES)
    assert list(stage) == ["language", "quality", "near_copies", "mixing", "packing"]

    known = work.keep(stage["language"](spark, docs, folder), "language")
    net = language.fit(docs)
    scores = [language.predict(net, [r[1]]) for r in rows()]
    want = Counter(r[0] for r, (langs, found) in zip(rows(), scores, strict=True) if langs[0] != "und" and found[0] >= language.least_score(len(net.langs), 0.2))
    assert Counter(r["doc_id"] for r in known.collect()) == want and known.columns == docs.columns

    good = work.keep(stage["quality"](spark, known, folder), "quality")
    judge = quality.fit(known, spark.read.parquet(f"{folder}/labels.parquet"))
    want = Counter(r["doc_id"] for r in known.collect() if judge.scores([r["text"]])[0] >= 0.5)
    assert Counter(r["doc_id"] for r in good.collect()) == want and good.columns == docs.columns

    single = work.keep(stage["near_copies"](spark, good, folder), "single")
    texts = [(r["doc_id"], r["text"]) for r in good.collect()]
    want = {d for d, n, c in brute_components(texts, 5, 80) if d is None or n == 0 or c == d}
    assert {r["doc_id"] for r in single.collect()} == want and single.columns == docs.columns
    assert max(Counter(r["doc_id"] for r in single.collect() if r["doc_id"] is not None).values()) == 1

    mixed = work.keep(stage["mixing"](spark, single, folder), "mixed")
    want = Counter()
    for r in mixing.mix_report(single, work).collect():
        want[r["doc_id"]] += r["taken"] // max(1, r["size"])
    assert Counter(r["doc_id"] for r in mixed.collect()) == +want and mixed.columns == docs.columns

    packed = stage["packing"](spark, mixed, folder).collect()
    words = Counter()
    for r in packed:
        words[r["doc_id"]] += r["size"]
    want = Counter()
    for r in mixed.collect():
        want[r["doc_id"]] += n_words(r["text"])
    assert +words == +want


class Most(AccumulatorParam):
    def zero(self, value):
        return value

    def addInPlace(self, a, b):
        return max(a, b)


def test_stages_read_texts_in_small_batches(spark, tmp_path, monkeypatch):
    """Whatever runs a stage's frame: the limit must hold when the caller writes it, not only while a stage of ours is written."""
    monkeypatch.setattr(language, "TRAIN_STEPS", 5)
    key, most = "spark.sql.execution.arrow.maxBytesPerBatch", spark.sparkContext.accumulator(0, Most())
    steps = language.steps

    def seen(batches, *args):
        for batch in batches:
            most.add(batch.nbytes)
            yield from steps([batch], *args)

    monkeypatch.setattr(language, "steps", seen)
    docs = spark.range(40, numPartitions=1).selectExpr("id as doc_id", "repeat('tree ', 100000) as text", "'en' as lang")
    before = spark.conf.get(key, None)
    try:
        spark.conf.unset(key)
        found = dict(corpus_pipeline.STAGES)["language"](spark, docs, str(tmp_path))
        assert found.count() == 40 and 0 < most.value < 6_000_000
        spark.conf.set(key, "1m")
        dict(corpus_pipeline.STAGES)["language"](spark, docs, str(tmp_path))
        assert spark.conf.get(key) == "1m"  # a limit of the session's own stays
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
