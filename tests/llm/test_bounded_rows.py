"""How many rows and texts a task makes or holds at a time."""

import glob

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import SMALL

from grainhouse.llm import common, lm_difference, pieces, repair, toxicity


def _sums(rows):
    blobs = [[np.array([r[c] for r in row], d).tobytes() for row in rows] for c, d in enumerate(("<u8", "<f8", "<f8"))]
    return pa.RecordBatch.from_pylist([{"keys": k, "u": u, "v": v} for k, u, v in zip(*blobs, strict=True)] + [{"keys": None, "u": None, "v": None}])


def test_sums_of_many_buckets_are_added_before_they_are_dealt(monkeypatch):
    rng = np.random.default_rng(3)
    rows = [[(int(k), float(k % 5), 0.25) for k in rng.choice(50, 20, replace=False)] for _ in range(40)]
    want = {k: (sum(r[1] for row in rows for r in row if r[0] == k), sum(r[2] for row in rows for r in row if r[0] == k)) for k in range(50)}
    batches = [_sums(rows[:25]), _sums(rows[25:])]
    whole = list(lm_difference._added_up(iter(batches)))
    assert len(whole) == 1 and len(whole[0][0]) == 50, "40 rows of buckets are one row to deal"
    assert {int(k): (u, v) for k, u, v in zip(*whole[0], strict=True)} == want
    monkeypatch.setattr(lm_difference, "SUM_KEYS", 100)
    parts = list(lm_difference._added_up(iter(batches)))
    assert len(parts) == 8
    assert {k: sum(u[keys == k].sum() for keys, u, _ in parts) for k in range(50)} == {k: u for k, (u, _) in want.items()}
    assert list(lm_difference._added_up(iter([_sums([])]))) == []


def test_tables_of_the_difference_are_zstd_and_the_setting_is_put_back(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(lm_difference, "_scored", lambda *_: seen.append(spark.conf.get("spark.sql.parquet.compression.codec")))
    before = spark.conf.get("spark.sql.parquet.compression.codec")
    spark.conf.set("spark.sql.parquet.compression.codec", "snappy")
    try:
        docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
        lm_difference.score_documents(docs, docs.select("doc_id"))
        assert seen == ["zstd"] and spark.conf.get("spark.sql.parquet.compression.codec") == "snappy"
    finally:
        spark.conf.set("spark.sql.parquet.compression.codec", before)


@pytest.mark.parametrize("rows", [0, 1, 256, 700])
def test_texts_are_strings_a_few_at_a_time(monkeypatch, rows):
    sizes, texts = [], common.texts
    monkeypatch.setattr(common, "texts", lambda batch, name="text": sizes.append(batch.num_rows) or texts(batch, name))
    given = [None if n % 7 == 0 else f"you idiot {n}" for n in range(rows)]
    batch = pa.RecordBatch.from_arrays([pa.array(given, pa.string())], names=["text"])
    model = toxicity.ToxicityModel({"idiot": 2.0}, (1.0, 1.0, 0.0, -1.0))
    matcher = toxicity.Matcher(model.weights)
    got = model.scores(matcher, common.each_text(batch))
    assert sum(sizes) == rows and max([0, *sizes]) <= 256
    assert got.tolist() == model.scores(matcher, texts(batch)).tolist()


def test_toxicity_reads_and_writes_texts_in_small_batches(spark, monkeypatch):
    import corpus_pipeline

    from grainhouse.llm import queries
    from grainhouse.sources.store import Store

    key, seen, write = "spark.sql.execution.arrow.maxBytesPerBatch", [], Store.overwrite
    before = spark.conf.get(key)
    monkeypatch.setattr(Store, "overwrite", lambda store, df, name, *rest: (seen.append((name, spark.conf.get(key))), write(store, df, name, *rest))[1])
    scored = queries.queries()["op3_toxicity"](spark, SMALL)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = corpus_pipeline.drop_toxic(spark, docs, SMALL)
    assert seen == [("scored", "8m"), ("kept", "8m")] and spark.conf.get(key) == before
    assert scored.columns == ["doc_id", "held_out", "score", "predicted"] and kept.schema == docs.schema
    bad = {r.doc_id for r in scored.where("predicted = 1").collect()}
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - bad


def test_pieces_hold_few_texts_and_no_words_after_a_task(monkeypatch):
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        codec = pieces.PieceCodec(file.read())
    held, read = [], pieces.texts
    monkeypatch.setattr(pieces, "texts", lambda batch: (held.append(batch.num_rows), read(batch))[1])
    own = [f"word{k} and word{k % 7}" for k in range(1300)] + [None, ""]
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64())])
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(own))), "text": own})
    rows = [r for b in pieces._encoded(iter([batch]), codec, schema, ["doc_id"], lambda _, ids: [[len(i) for i in ids]]) for r in b.to_pylist()]
    assert rows == [{"doc_id": k, "n": len(codec.library.encode(t or ""))} for k, t in enumerate(own)]
    assert max(held) <= 512 and sum(held) == len(own)
    assert not codec.memo and not len(codec.memo_ids)


def _one_by_one(keys, counts, base):
    order = np.argsort(-counts, kind="stable")
    begins, ends, chosen = set(), set(), []
    for k in order.tolist():
        a, b = divmod(int(keys[k]), base)
        if a not in ends and b not in begins and (a != b or a not in begins):
            begins.add(a)
            ends.add(b)
            chosen.append(int(keys[k]))
    return sorted(chosen)


@pytest.mark.parametrize("passes", [1, 20])
def test_pairs_chosen_together_are_those_chosen_one_by_one(monkeypatch, passes):
    monkeypatch.setattr(repair, "PASSES", passes)
    rng = np.random.default_rng(4)
    for _ in range(300):
        base = int(rng.integers(2, 14))
        keys = np.unique(rng.integers(0, base * base, rng.integers(0, 120)))
        counts = rng.integers(2, 6, len(keys))
        assert repair._choose(keys, counts, base).tolist() == _one_by_one(keys, counts, base)
    chain = np.arange(200) * 202 + 1  # (0, 1), (1, 2), ...: each pair excludes the next
    counts = np.arange(300, 100, -1)
    assert repair._choose(chain, counts, 201).tolist() == _one_by_one(chain, counts, 201)


def test_a_chunk_is_a_row_group_of_its_own(spark, store, monkeypatch):
    docs = spark.createDataFrame([(n, f"w{n % 40} of w{n % 7} and w{n % 11} in w{n % 5}") for n in range(200)], "doc_id long, text string").coalesce(1)
    target = docs.where("doc_id % 3 = 0").select("doc_id")
    key = "parquet.block.row.count.limit"
    monkeypatch.setattr(lm_difference, "CHUNK_TOKENS", 100)
    monkeypatch.setattr(lm_difference, "scratch", lambda *_: store)
    scores = lm_difference.score_documents(docs, target).collect()
    assert len(scores) == 200 and spark.conf.get(key, None) is None
    files = [pq.ParquetFile(f).metadata for f in glob.glob(store.path("coded/*.parquet"))]
    groups = [m.row_group(g).num_rows for m in files for g in range(m.num_row_groups)]
    assert len(groups) > 10 and set(groups) == {1} and len(files) < len(groups), "a task reads and writes one chunk at a time"


def test_rows_for_buckets_are_handed_back_a_few_at_a_time(monkeypatch):
    keys = np.arange(5000, dtype=np.uint64)
    counts = keys.astype(np.int64)
    (whole,) = lm_difference._dealt(3, keys, 64, "<i8", keys, counts, counts)
    monkeypatch.setattr(lm_difference, "BATCH_BYTES", 10_000)
    parts = list(lm_difference._dealt(3, keys, 64, "<i8", keys, counts, counts))
    assert len(parts) > 10 and max(p.nbytes for p in parts) < 12_000
    assert pa.Table.from_batches(parts).to_pylist() == whole.to_pylist()
