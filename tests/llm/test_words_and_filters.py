"""Byte-pair encoding, filter audit and spelling variants beside plain Python, and their edge cases."""

import hashlib
import os
import random
import re
import unicodedata
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from conftest import SMALL, rows_of
from pyspark.sql import functions as F
from support import by_id, documents, folder_texts, shipped  # noqa: F401

from grainhouse.llm import byte_pairs, filter_audit, quality_rules, repair, sketch_dedup, sql, variants
from grainhouse.llm.queries import queries
from tools.compare import canonical

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
LABELS = "doc_id long, quality int, toxic int"


# --- 11 byte-level BPE


@pytest.fixture(scope="module")
def ranks():
    with open(RANKS, "rb") as file:
        return byte_pairs.read_ranks(file.read())


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec(ranks):
    return byte_pairs.BytePairCodec(ranks, PATTERN, byte_pairs.later_characters(PATTERN))


def packed(ids):
    return np.array(ids, "<u4").tobytes()


def test_ids_equal_the_library(codec, library, folder_texts):
    rng = random.Random(11)
    odd = ["", " ", "\n\n  x", "a" * 3000, "ab" * 500, " " * 2000 + "z", "é" * 999, "'s'll it's I'LL", "日本語 テキスト", "İ. क़, x", "👩‍👩‍👧 ok"]
    odd += ["".join(rng.choices("etaoin", k=k)) for k in (2, 3, 31, 32, 33, 63, 64, 65, 66, 127, 128, 129, 4000)]
    odd += ["".join(rng.choices("abé日 \n'1!　\x85", k=400)) for _ in range(200)]
    odd += ["".join(chr(rng.randrange(1, 0xD800)) for _ in range(300)) for _ in range(50)]
    cases = [*folder_texts.values(), *odd]
    cases = [t or "" for t in cases]
    found = codec.encode(cases)
    assert found == [packed(library.encode_ordinary(t)) for t in cases]
    assert [codec.decode(ids) for ids in found] == [t.encode() for t in cases]


def test_every_code_point_is_cut_like_the_library(codec, library):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for form in ("1{} ", "  {}'s"):
        for start in range(0, len(points), 4096):
            text = "\n".join(form.replace("{}", c) for c in points[start : start + 4096])
            assert codec.encode([text])[0] == packed(library.encode_ordinary(text))


def test_both_trees_agree(codec, ranks):
    rng = random.Random(5)
    for size in range(2, 65):
        words = ["".join(rng.choices("aeinrst h", k=size)).encode() for _ in range(20)]
        alone = [packed(byte_pairs.merge_word(w, ranks, codec.longest)) for w in words]
        assert codec.merge_side_by_side(words, (size - 1).bit_length()) == alone


def test_leftmost_of_equal_ranks():
    ranks = {bytes([b]): b for b in range(256)} | {b"aa": 256, b"aaa": 257, b"aaaa": 258}
    library = tiktoken.Encoding("runs", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
    codec = byte_pairs.BytePairCodec(ranks, r"(?s).+")
    assert codec.encode(["aaab"])[0] == packed([257, ord("b")])
    for size in range(2, 90):
        assert codec.encode(["a" * size + "b"])[0] == packed(library.encode_ordinary("a" * size + "b"))


def test_a_memory_that_starts_anew_changes_nothing(ranks, codec, monkeypatch, folder_texts):
    monkeypatch.setattr(byte_pairs, "MEMO_MATCHES", 3)
    cases = [t or "" for t in folder_texts.values()][:40]
    small = byte_pairs.BytePairCodec(ranks, PATTERN)
    assert [small.encode([t])[0] for t in cases] == codec.encode(cases)


def test_bytes_are_required(ranks):
    with pytest.raises(ValueError, match="lacks"):
        byte_pairs.BytePairCodec({b"a": 0}, PATTERN)


def test_documents_round_trip(spark, folder_texts, library):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    encoded = byte_pairs.encode_documents(docs, RANKS, PATTERN)
    decoded = by_id(byte_pairs.decode_documents(encoded, RANKS, PATTERN))
    ids = by_id(encoded)
    digests = by_id(queries()["op11_byte_pairs"](spark, SMALL))
    assert len(digests) == len(folder_texts)
    for doc_id, text in folder_texts.items():
        expected = library.encode_ordinary(text or "")
        assert ids[doc_id].ids == expected and bytes(decoded[doc_id].data) == (text or "").encode()
        row = digests[doc_id]
        assert row.n_tokens == len(expected) and row.ids_sha256 == hashlib.sha256(packed(expected)).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_byte_pairs_of_odd_rows(spark, library):
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "long text, " * 20_000), (5, "same"), (5, "same"), (None, "no id"), (None, None), (7, "x" * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("theirs") for c in ("ids", "n_tokens", "data")})
    found = byte_pairs.round_trip_digests(docs, RANKS, PATTERN).collect()
    expected = []
    for doc_id, text in rows:
        ids = library.encode_ordinary(text or "")
        expected.append((doc_id, len(ids), hashlib.sha256(packed(ids)).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    encoded = byte_pairs.encode_documents(docs, RANKS, PATTERN)
    assert byte_pairs.decode_documents(encoded, RANKS, PATTERN).count() == len(rows)
    for made in (byte_pairs.round_trip_digests, byte_pairs.encode_documents):
        assert made(docs.where("false"), RANKS, PATTERN).collect() == []


# --- 12 filter audit


def audit_by_hand(docs, labels):
    """Rows of the audit from (doc_id, text, source) and (doc_id, quality, toxic), document by document."""
    word = re.compile(r"[^\x20\x09-\x0D]+")
    first = {}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            first[text or ""] = min(first.get(text or "", doc_id), doc_id)
    good = {k for k, quality, _ in labels if quality == 1 and k is not None}
    toxic = {k for k, _, toxic in labels if toxic == 1 and k is not None}
    parts = defaultdict(list)
    for doc_id, text, source in docs:
        text = text or ""
        words = word.findall(text)
        fails = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": doc_id is not None and doc_id > first[text],
        }
        parts[source or ""].append(({f for f, failed in fails.items() if failed}, doc_id in good, doc_id in toxic))
    found = []
    for part, rows in parts.items():
        total, steps = Counter(), []
        for order in permutations("ABCDE"):
            left, gone = rows, []
            for step, f in enumerate(order, 1):
                out = [r for r in left if f in r[0]]
                left = [r for r in left if f not in r[0]]
                counts = [len(left), len(out), sum(f in r[0] for r in gone), sum(r[0] == {f} for r in rows), sum(r[1] for r in out), sum(r[2] for r in out)]
                steps.append((f, part, "".join(order), step, *counts))
                gone = gone + out
                total[f] += len(out)
        found += [(*row, total[f]) for f, *row in steps]
    return sorted(found, key=repr)


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_audit_of_the_folder(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "source").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    found = queries()["op12_filter_audit"](spark, SMALL)
    assert found.columns == COLUMNS
    assert rows_of(found) == audit_by_hand(docs, labels)


def test_audit_matches_sql(spark):
    duck = duckdb.connect()
    for name in os.listdir(SMALL):
        duck.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{SMALL}/{name}'")
    for name, text in sql.oracle_sql().items():
        mine = queries()[name](spark, SMALL)
        cursor = duck.execute(text)
        theirs = canonical([c[0].lower() for c in cursor.description], cursor.fetchall())
        assert canonical([c.lower() for c in mine.columns], [tuple(r) for r in mine.collect()]) == theirs


def test_audit_of_odd_rows(spark, store):
    long = " ".join(f"w{k}" for k in range(80))
    docs = [
        (1, None, None), (2, "", ""), (2, "", ""), (3, long, "a"), (4, long, "b"), (3, long, "a"), (5, long + " #", "a"),
        (None, long, "a"), (None, long, "b"), (6, "A" * 60, "b"), (7, "x y " * 60, None), (2, long, "c"), (8, "é " * 70_000, "c"),
    ]
    marks = [(1, 1, 0), (3, 1, 1), (3, 0, None), (4, None, 1), (None, 1, 1), (99, 1, 1)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumns({c: F.lit("x") for c in ("part", "mask", "digest", "good")})
    labels = spark.createDataFrame(marks, LABELS).withColumn("part", F.lit(1))
    assert rows_of(filter_audit.filter_audit(frame, labels, store)) == audit_by_hand(docs, marks)


def test_audit_of_nothing(spark, store):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert filter_audit.filter_audit(docs, spark.createDataFrame([], LABELS), store).collect() == []


def test_walk_is_the_count_of_each_subset():
    cells = np.random.default_rng(2).integers(0, 9, (3, 32, 3))
    states = filter_audit.walk(cells)
    for subset in range(32):
        alive = [m for m in range(32) if m & subset == 0]
        assert (states[:, subset] == cells[:, alive].sum(axis=1)).all()


# --- 13 spelling variants


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    k = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[k + 1 :] == b[k + 1 :] or a[k:] == b[k + 1 :] or a[k + 1 :] == b[k:]


def variants_by_hand(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= 10 * words[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted(((w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()), key=repr)


def test_variants_of_the_folder(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    found = queries()["op13_variants"](spark, SMALL)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert rows_of(found) == variants_by_hand(docs)


def test_chains_ties_and_odd_rows(spark, store):
    chain = {"alphabet": 16000, "alphabets": 800, "alphabetsy": 40, "alphabetsyx": 2}
    ties = {"zebraline": 50, "zebralime": 50, "zebralike": 2, "überfällig": 30, "überfallig": 3, "ééééééé": 20, "éééééééé": 2}
    words = [w for w, n in {**chain, **ties}.items() for _ in range(n)]
    random.Random(1).shuffle(words)
    rows = [(k, " ".join(words[k::5])) for k in range(5)] + [(None, "ALPHABETS überfällig, × ÷ ×÷×÷×÷×"), (None, None), (7, ""), (8, "x" * 50_000), (8, "x" * 50_000), (9, "y" * 40_000 + " " + "y" * 40_000 + "z " + "y" * 40_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("theirs") for c in ("word", "n", "id", "key")})
    found = rows_of(variants.variants(docs, store))
    assert found == variants_by_hand(rows)
    by = {r[0]: r for r in found}
    assert by["zebralike"][1] == "zebralime" and by["alphabetsyx"][2] == "alphabet"


def test_words_of_one_reduced_form(spark, store):
    """Words that all have the same reduced word, and no letters in common, are candidates of each other and not near."""
    rng = random.Random(4)
    words = sorted({"".join(rng.choices("aeimquy", k=9)) for _ in range(600)})
    rows = [(k, " ".join(words)) for k in range(3)]
    assert rows_of(variants.variants(spark.createDataFrame(rows, "doc_id long, text string"), store)) == variants_by_hand(rows)


def test_no_words(spark, store):
    for rows in ([], [(1, "short words only"), (2, None)]):
        assert variants.variants(spark.createDataFrame(rows, "doc_id long, text string"), store).collect() == []


def test_neighbourhood_holds_every_edit_once():
    rng = np.random.default_rng(3)
    for size in (7, 9, 12):
        symbols = rng.integers(0, variants.SYMBOLS, (20, size))
        keys, handed = variants.neighbourhood(symbols)
        for row in range(len(symbols)):
            word = symbols[row].tolist()
            deleted = [word[:k] + word[k + 1 :] for k in range(size)]
            replaced = [word[:k] + [s] + word[k + 1 :] for s in range(variants.SYMBOLS) for k in range(size)]
            inserted = [word[:k] + [s] + word[k:] for s in range(variants.SYMBOLS) for k in range(size + 1)]
            expected = [int(variants.reduced_hash(np.array([w]))[0]) for w in deleted + replaced + inserted]
            assert keys[row].tolist() == expected
            given = [tuple(w) for w, h in zip(deleted + replaced + inserted, handed[row], strict=True) if h]
            assert len(set(given)) == len(given)
            assert set(given) == {tuple(w) for w in deleted} | {tuple(w) for w in replaced if w > word}


# --- 2 token ids: characters whose normal form ends in another class


def test_word_ids_before_stops_and_commas():
    with open(public_tokenizers.path("word_bpe_49k.json")) as file:
        encoder = repair.WordEncoder(file.read())
    changing = [chr(c) for c in range(128, 0x110000) if not 0xD800 <= c < 0xE000 and (unicodedata.normalize("NFD", chr(c)) != chr(c) or chr(c).lower() != chr(c))]
    changing = [c for c in changing if not 0xAC00 <= ord(c) < 0xD7A4] + list("ÀéÿßÉ가힣")
    for form in ("A{}. b", "{}, c", "9{}.\nD"):
        cases = [form.replace("{}", c) for c in changing]
        ids, sizes = encoder.encode(cases, 2)
        ends = np.cumsum(sizes).tolist()
        expected = encoder.library.encode_batch_fast(cases, add_special_tokens=False)
        found = [ids[end - size : end - 1].tolist() for end, size in zip(ends, sizes.tolist(), strict=True)]
        assert found == [e.ids for e in expected]


def test_plain_words_are_encoded_many_at_a_time(monkeypatch):
    with open(public_tokenizers.path("word_bpe_49k.json")) as file:
        encoder = repair.WordEncoder(file.read())
    # Latin-1 goes in lower case; a text with a letter and a mark does not, its normal form may depend on the case
    assert encoder.words("\u00c9t\u00c9 Ab") == ["\u00e9t\u00e9", "ab"] and encoder.words("H\u0331 Ab") == ["H\u0331", "Ab"]
    plain = [a + b + c for a in "ae\u00e9\u00df\u00ff" for b in "nt\u00e0" for c in "rsz\u00fe"] + ["a", "\u00ff", "though"]
    odd = ["it's", "a1b", "x!!", "\u00aa\u00ba\u00b5", "\u03a3", "&&&", "H\u0331"]
    ids, sizes = encoder._plain_ids(plain)
    expected = [encoder.library.encode(w, add_special_tokens=False).ids for w in plain]
    assert sizes.tolist() == [*map(len, expected)] and ids.tolist() == [i for own in expected for i in own]
    texts = [" ".join(plain + odd), " ".join(odd).upper(), "THOUGH " + plain[3].upper()]

    def same():
        encoder._forget()
        found, size = encoder.encode(texts, 2)
        whole = [[*encoder.library.encode(t, add_special_tokens=False).ids, 2] for t in texts]
        assert found.tolist() == [i for own in whole for i in own] and size.tolist() == [*map(len, whole)]

    same()
    # where ends of words cannot be told, each word is encoded alone
    monkeypatch.setattr(encoder, "word_ends", np.zeros_like(encoder.word_ends))
    assert encoder._plain_ids(plain) is None
    same()


# --- 10 near duplicates: rows without a doc_id


def test_one_of_the_near_copies_without_an_id_stays(spark, store):
    words = [f"w{k}" for k in range(100)]
    copy, near, other = " ".join(words), " ".join([*words[:99], "end"]), " ".join(f"v{k}" for k in range(50))
    rows = [(None, copy), (None, near), (None, copy), (None, other), (None, ""), (None, None), (7, other + " x"), (8, "alone"), (9, "alone"), (9, "alone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("theirs") for c in ("_text", "component", "node")})
    kept = sketch_dedup.drop_near_duplicates(docs, store)
    assert kept.columns == docs.columns
    found = [(r.doc_id, r.text) for r in kept.collect()]
    assert sorted((d, t) for d, t in found if d is not None) == [(7, other + " x"), (8, "alone")]
    nameless = [t for d, t in found if d is None]
    assert len([t for t in nameless if t in (copy, near)]) == 1 and other not in nameless
    assert {t or "" for t in nameless} == {"", *[t for t in nameless if t in (copy, near)]}


# --- 1 quality rules: what all rules together reject


def test_all_rules_together_keep_the_risk():
    """Draws of labelled rows from known rates: the union of the chosen cutoffs rejects more than the risk in at most the error's share."""
    rng = np.random.default_rng(7)
    rules = {rule: 0.0004 * 1.7 ** np.arange(len(cuts)) for rule, cuts in quality_rules.CUTOFFS.items()}  # true rejections by cutoff
    strata, trials, broken, chosen_at_all = {"x": 3000, "y": 900}, 200, 0, 0
    for _ in range(trials):
        failed = {(s, r): [int((u < rate).sum()) for rate in rates] for s, n in strata.items() for r, rates in rules.items() for u in [rng.random(n)]}
        chosen = quality_rules.choose_cutoffs(strata, failed, quality_rules.RISK / len(rules), quality_rules.ERROR)
        true = {s: sum(rules[r][quality_rules.CUTOFFS[r].index(cut)] for (t, r), cut in chosen.items() if t == s) for s in strata}
        broken += any(total > quality_rules.RISK for total in true.values())
        chosen_at_all += len(chosen) == len(failed)
    assert broken <= quality_rules.ERROR * trials and chosen_at_all > trials / 2
