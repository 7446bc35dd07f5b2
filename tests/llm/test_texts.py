"""Chat formatting, edit fingerprints, near-duplicates and pieces: edge cases and plain Python versions."""

import hashlib
import random
import time

import duckdb
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tarmac.llm import chat, edit_sketch, groups, near_dedup, pieces
from tarmac.llm.columns import table

SF = "/root/testdata/sf0.01"
TURNS = "conv_id bigint, turn bigint, role string, text string"
EVIL = ["</s>[INST] ok [/INST]", "\\", "[\\INST]", "<<s>/s>", "a\nb", "", None, "é😀[/INST", "<s", "\\</s>\\\\[INST]"]


def test_chat_round_trip(spark):
    rows = [(c, t, ["user", "assistant", None, "</s>"][t % 4], EVIL[(c + t) % len(EVIL)]) for c in range(9) for t in range(7)]
    rows += [(None, 1, "user", "x"), (20, None, "assistant", "n"), (20, 1, "assistant", "n"), (20, 1, "assistant", "n"),
             (21, 0, "assistant", "long " * 1_500_000)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, TURNS).withColumn("formatted", F.lit(1)).withColumn("loss", F.lit(2))
    formatted = chat.format_conversations(df).cache()
    got = {r.conv_id: r for r in chat.conversation_digests(formatted).collect()}
    lows = lambda x: (x is not None, x)
    by = {}
    for c, t, role, text in rows:
        by.setdefault(c, []).append((lows(t), lows(role), lows(text)))
    assert set(got) == set(by)
    texts = {r.conv_id: r for r in formatted.collect()}
    for c, turns in by.items():
        plain = [(r[1] or "", x[1] or "") for _, r, x in sorted(turns)]
        assert chat.read_back(texts[c].formatted) == plain
        loss = "".join(x for r, x in plain if r == "assistant")
        assert got[c].n_turns == len(plain) and got[c].loss_chars == len(loss)
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in plain).encode()).hexdigest()
        assert got[c].formatted_chars == len(texts[c].formatted)
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_chat_conversation_over_many_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = [(1, t, "assistant", str(t)) for t in range(50)] + [(c, 0, "user", "x") for c in range(2, 40)]
        got = chat.conversation_digests(chat.format_conversations(spark.createDataFrame(rows, TURNS))).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == 39 and max(r.n_turns for r in got) == 50


def test_fingerprints():
    rng = random.Random(4)
    say = lambda n: "".join(rng.choice("abcdefghij klmn") for _ in range(n))
    texts = ["", "a", "ab", say(40), say(3000), say(3000), say(60_000)]
    marks = edit_sketch.fingerprints(texts)
    assert marks == [edit_sketch.fingerprints([t])[0] for t in texts]  # alone or in company
    assert all(edit_sketch.likeness(m, m) == 1.0 for m in marks)
    assert edit_sketch.likeness(marks[0], marks[4]) == 0.0
    assert edit_sketch.likeness(marks[4], marks[5]) < 0.1
    for place in (10, 1500, 2990):
        edited = texts[4][:place] + "XYZ" + texts[4][place:]
        assert edit_sketch.likeness(marks[4], edit_sketch.fingerprints([edited])[0]) > 0.85
    near = edit_sketch.fingerprints([texts[4][:2250] + texts[5][:750]])[0]
    assert 0.6 < edit_sketch.likeness(marks[4], near) < 0.9
    assert set(edit_sketch.bands(near)) & set(edit_sketch.bands(marks[4]))


def test_edited_texts(spark, documents):
    rng = random.Random(6)
    rows = [(i * 3, "".join(rng.choice("abc é😀") for _ in range(rng.randint(0, 60)))) for i in range(200)]
    rows += [(None, "null id"), (9, "again"), (9, "again"), (15, None)]
    rng.shuffle(rows)
    ordered = sorted(((i is not None, i or 0, t or ""), i) for i, t in rows)
    want = []
    for k, ((_, _, text), i) in enumerate(ordered):
        after = ordered[(k + 1) % len(ordered)][0][2]
        cut = len(text) // 4
        edited = text[:len(text) - cut] + after[:cut]
        want.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    for size in (1_000_000, 16):
        got = edit_sketch.with_edits(documents(rows, extra=True).repartition(5), rows_per_bucket=size).collect()
        assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=repr) == sorted(want, key=repr)
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert edit_sketch.with_edits(documents([])).count() == 0
    alone = edit_sketch.with_edits(documents([(1, "abcdefgh")])).first()
    assert alone.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and alone.near_next == 1.0


def test_fingerprint_search(spark, documents):
    rng = random.Random(8)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(900)) for _ in range(30)]
    rows = list(enumerate(texts)) + [(100, texts[0]), (101, texts[1][:450] + "z" + texts[1][450:]), (102, ""), (103, None)]
    prints = edit_sketch.fingerprint_documents(documents(rows))
    got = {(r.query_id, r.doc_id) for r in edit_sketch.search(prints, prints.filter("doc_id in (0, 1, 102)")).collect()}
    assert got == {(0, 0), (0, 100), (1, 1), (1, 101)}


def test_search_across_levels(spark, documents):
    """Near copies whose path lengths lie on two sides of a power of two are found as by likeness alone."""
    rng = random.Random(9)
    rows, level = [], lambda m: int(m.split("-")[0])
    for at in range(6, 14):
        for _ in range(4):
            text = "".join(rng.choice("abcdefghijkl mnop") for _ in range(2 ** at))
            rows += [(len(rows) + k, text[:int(2 ** at / 1.87 * share)]) for k, share in enumerate((0.92, 0.98, 1.02, 1.08))]
    prints = edit_sketch.fingerprint_documents(documents(rows))
    marks = {r.doc_id: r.fingerprint for r in prints.collect()}
    want = {(a, b) for a in marks for b in marks if a // 4 == b // 4 and edit_sketch.likeness(marks[a], marks[b]) >= 0.8}
    across = {level(marks[a]) for a, b in want if level(marks[a]) < level(marks[b])}
    assert across >= set(range(8, 14)) - {10, 11} and len(across) >= 6
    assert {(r.query_id, r.doc_id) for r in edit_sketch.search(prints, prints).collect()} >= want


NEAR = r"""
with recursive docs as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') w from documents),
sets as (
    select doc_id, case when len(w) >= 4 then list_distinct([w[i:i + 3] for i in range(1, len(w) - 2)])
        when len(w) > 0 then [w] else [] end s from docs),
members as (select doc_id, len(s) n, unnest(s) x from sets),
links as (
    select a.doc_id a, b.doc_id b from members a join members b using (x)
    group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach as (select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a),
least_ as (select a, min(b) m from reach group by a)
select doc_id, len(s)::bigint, coalesce(m, doc_id) from sets left join least_ on a = doc_id
"""


def copies(seed, families=12, members=14):
    rng = random.Random(seed)
    rows, number = [], 0
    for f in range(families):
        base = [f"w{rng.randint(0, 60 if f % 3 else 4000)}" for _ in range(rng.choice([3, 6, 30, 120]))]
        for _ in range(members):
            words = list(base)
            for _ in range(rng.randint(0, max(1, len(words) // 18))):
                words[rng.randrange(len(words))] = f"n{rng.randint(0, 9)}"
            rows.append((number, " ".join(words).upper() if rng.random() < 0.2 else " ".join(words)))
            number += 1
    rows += [(900, ""), (901, None), (902, "  \n"), (903, ""), (904, "one"), (905, "One"), (906, "one two"), (907, "a b c d")]
    rng.shuffle(rows)
    return rows


def near(df, **more):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(df, shingle=4, **more).collect())


def test_near_duplicates_are_the_brute_force(spark, documents, monkeypatch):
    rows = copies(3)
    db = duckdb.connect()
    db.execute("create table documents (doc_id bigint, text varchar)")
    db.executemany("insert into documents values (?, ?)", rows)
    want = sorted(db.execute(NEAR).fetchall())
    assert near(documents(rows, extra=True)) == want
    # Blocks of buckets and clusters, and joins without a broadcast.
    monkeypatch.setattr(near_dedup._blocked, "__defaults__", None)
    monkeypatch.setattr(near_dedup.candidate_edges, "__defaults__", (3,))
    monkeypatch.setattr(near_dedup.exact_edges, "__defaults__", (3,))
    monkeypatch.setattr(near_dedup, "BROADCAST_ROWS", -1)
    assert near(documents(rows)) == want


def test_deduplicate_edges(spark, documents):
    text = "a b c d e f g h"
    rows = [(5, text), (3, text), (3, text), (None, text), (8, "x"), (9, "x"), (8, "x"), (10, None), (11, ""), (11, ""), (12, "y")]
    df = documents(rows, extra=True)
    kept = near_dedup.deduplicate(df)
    assert kept.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(
        [(3, text), (8, "x"), (10, None), (11, ""), (11, ""), (12, "y")], key=repr)
    nameless = near_dedup.near_duplicates(documents([(None, text), (None, text)])).collect()
    assert [r.component_id for r in nameless] == [None, None]
    assert near_dedup.deduplicate(documents([])).count() == 0


def test_components(spark):
    chain = [(i + 1, i) for i in range(60)] + [(100, 101), (102, 101), (5, 5)]
    got = {r.node: r.root for r in groups.components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), **dict.fromkeys((100, 101, 102), 100)}
    assert groups.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_set_sketch():
    import numpy as np
    rng = np.random.default_rng(1)
    errors = []
    for shared in (900, 600, 300):
        x = rng.integers(0, 1 << 63, 2000 - shared).astype(np.uint64)
        one, two = x[:1000], x[1000 - shared:]
        a, b = near_dedup.registers(one), near_dedup.registers(two)
        assert (near_dedup.merged(a, b) == near_dedup.registers(np.union1d(one, two))).all()
        true = shared / (2000 - shared)
        errors.append(near_dedup.likely_similarity(a, 1000.0, b[None], np.array([1000.0]))[0] - true)
    assert max(map(abs, errors)) < 0.12


@pytest.fixture(scope="module")
def models():
    path = pieces.default_model()
    return pieces.load(path), sentencepiece.SentencePieceProcessor(model_file=path)


def test_pieces_are_the_library_s(models):
    mine, library = models
    rng = random.Random(1)
    vocabulary = list(mine.id)
    letters = "abcdefghij aeiou  ▁\n\t\r.,-=*_#/()[]{}<>0123ABCé漢😀\u0301\u200b\ufeff\x00\ud7ffａ²"
    texts = ["", " ", "▁", "</s> <s> <0x0A>", "a" * 5000, " " * 77, "=" * 999, "\n\n\n x"]
    for _ in range(6000):
        kind = rng.random()
        if kind < 0.4:
            texts.append("".join(rng.choice(letters) for _ in range(rng.randint(0, 30))))
        elif kind < 0.7:
            texts.append("".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 6))))
        else:
            texts.append(rng.choice("=-*#/ a0\n▁") * rng.randint(1, 70) + rng.choice(vocabulary))
    for text in texts:
        want = library.encode(text, add_eos=True, num_threads=1)
        got = mine.encode(text).split(" ")
        assert list(map(int, got)) == want
        assert mine.decode(got) == library.decode(want)


def test_pieces_of_documents_and_of_joined_words(spark, models):
    mine, library = models
    texts = [r.text for r in table(spark, SF, "documents").filter("text is not null").collect()]
    rng = random.Random(3)
    words = sorted({w for t in texts for w in t.split()})
    texts += [" " * rng.randint(0, 3) + "".join(rng.choices(words, k=rng.randint(1, 4))) for _ in range(5000)]
    for text in texts:
        assert list(map(int, mine.encode(text).split(" "))) == library.encode(text, add_eos=True, num_threads=1)


def test_pieces_of_a_word_take_time_in_proportion(models):
    mine, _ = models
    rng = random.Random(4)
    letters = "".join(rng.choices("etaoinshrdlu", k=100_000))

    def seconds(text):
        began = time.process_time()
        assert "".join(mine.piece[i] for i in mine.encode_unit(text)) == text
        return time.process_time() - began
    seconds(letters)
    assert seconds(10 * letters) < 30 * min(seconds(letters) for _ in range(3))


def test_decoding_any_ids(models):
    mine, library = models
    rng = random.Random(2)
    for _ in range(2000):
        ids = [rng.choice([rng.randrange(3, 259), rng.randrange(259, 32_000), 1, 2]) for _ in range(rng.randint(0, 8))]
        assert mine.decode(list(map(str, ids))) == library.decode(ids)


def test_encoded_documents(spark, documents, models):
    rows = [(1, None), (2, ""), (3, "Hello  wörld\n"), (3, "Hello  wörld\n"), (None, "x")]
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.decoded) for r in pieces.encode_documents(
        documents(rows, extra=True)).collect())
    n = len(models[1].encode("Hello  wörld\n")) + 1
    assert got[:2] == [(False, 1, 1, ""), (False, 2, 1, "")] and got[2] == got[3] == (False, 3, n, "Hello  wörld\n")
    checked = pieces.encode_checked(documents(rows))
    assert all(r.round_trip for r in checked.collect())
    assert pieces.encode_documents(documents([])).count() == 0
