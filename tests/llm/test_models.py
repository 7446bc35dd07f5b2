"""Language, toxicity and language models: edge cases, plain Python versions, held-out accuracy."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tarmac.llm import elias_fano, langid, language_model, toxicity
from tarmac.llm.columns import id_remainder, table

SF = "/root/testdata/sf0.01"


def remainder(i, n):
    return zlib.crc32(str(i).encode()) % n


def test_language_held_out_accuracy(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text", "lang")
    model = langid.fit_languages(docs.filter(id_remainder("doc_id", 3) != 1))
    got = langid.identify(docs.filter(id_remainder("doc_id", 3) == 1), model).collect()
    right = sum(r.lang == r.lang_pred for r in got)
    assert right / len(got) > 0.97 and all(0 <= r.score <= 1 for r in got)


def test_texts_of_no_language_go(spark, documents):
    docs = table(spark, SF, "documents")
    model = langid.fit_languages(docs.filter(id_remainder("doc_id", 3) != 1), calibrate=True)
    rng = np.random.default_rng(1)
    garbled = ["".join(chr(0x4E00 + int(c)) for c in rng.integers(0, 3000, 200)) for _ in range(20)]
    assert model.least_lead > 0 and langid.keep_identified(documents(list(enumerate(garbled))), model).count() == 0
    named = langid.identify(docs.filter("lang is not null"), model).filter("lang = lang_pred").select("doc_id")
    kept = langid.keep_identified(docs, model)
    assert named.join(kept, "doc_id", "left_anti").count() <= 0.005 * named.count()
    model.least_lead = -np.inf  # as without calibration
    kept = langid.keep_identified(docs, model)
    assert named.join(kept, "doc_id", "left_anti").count() == 0
    only = langid.keep_identified(docs, model, wanted=["de", "fr"])
    assert {r.lang for r in only.filter("lang is not null").select("lang").distinct().collect()} <= {"de", "fr", "en"}
    assert only.filter("lang = 'de'").count() == kept.filter("lang = 'de'").count() and only.filter("lang = 'es'").count() == 0


def test_texts_of_no_language_go_without_calibration(spark, documents):
    docs = table(spark, SF, "documents")
    rng = np.random.default_rng(2)
    garbled = [" ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(2, 9))) for _ in range(n))
               for n in (40, 200) for _ in range(20)]
    model = langid.fit_languages(docs)
    assert langid.keep_identified(documents(list(enumerate(garbled))), model).count() == 0
    named = langid.identify(docs, model).filter("lang = lang_pred").select("doc_id")
    assert named.join(langid.keep_identified(docs, model), "doc_id", "left_anti").count() == 0
    three = langid.fit_languages(docs.filter("lang != 'es'"))  # no label teaches the fourth
    kept = langid.keep_identified(docs, three)
    assert kept.filter("lang = 'es'").count() < 0.05 * docs.filter("lang = 'es'").count()
    assert kept.filter("lang != 'es'").count() == docs.filter("lang != 'es'").count()
    # Where every text is a landmark, what only itself holds does not count.
    few = langid.fit_languages(documents([(i, "the cat and the dog " * (1 + i % 3), "en") for i in range(12)]))
    lone = langid.fit_languages(documents([(1, "the cat", "en")]))
    assert few.least_known == {"en": pytest.approx(langid.KNOWN_SHARE)} and lone.least_known == {"en": 0.0}


def test_language_edges(spark, documents):
    rows = [(i, "the cat and the dog " * (1 + i % 3), "en") for i in range(12)]
    rows += [(20 + i, "der hund und die katze " * (1 + i % 3), "de") for i in range(12)]
    rows += [(50, None, "en"), (51, "", "en"), (None, "le chat", "fr"), (52, "x", None)]
    model = langid.fit_languages(documents(rows))
    assert model.classes == ["de", "en"]
    asked = documents([(1, None), (2, ""), (3, "123 !?"), (4, "und die katze"), (5, "the dog " * 40_000), (5, "漢")], extra=True)
    got = sorted(langid.identify(asked, model).collect(), key=lambda r: (r.doc_id, r.text or ""))
    assert [r.lang_pred for r in got][:4] == ["und"] * 3 + ["de"] and got[4].lang_pred == "en"
    assert got[0].score == 0.0 and got[5].lang_pred in model.classes
    assert "n_chars" in got[0].asDict()
    kept = langid.keep_identified(asked, model)
    assert kept.columns == asked.columns and {4, 5} <= {r.doc_id for r in kept.collect()} <= {4, 5}
    empty = langid.fit_languages(documents([]))
    assert [r.lang_pred for r in langid.identify(documents([(1, "the")]), empty).collect()] == ["und"]
    assert langid.identify(documents([]), model).count() == 0


@pytest.mark.parametrize("count", [2, 4, 24])
def test_no_identified_document_goes_with_many_languages(spark, documents, count):
    rng = np.random.default_rng(11)
    rows = []
    for lang in range(count):
        words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(3, 8))) for _ in range(60)]
        rows += [(1000 * lang + i, " ".join(rng.choice(words, 2 if i % 2 else 25)), f"l{lang}") for i in range(40)]
    docs = documents(rows)
    model = langid.fit_languages(docs.filter("doc_id % 4 > 1"))
    asked = docs.filter("doc_id % 4 < 2")
    right = {r.doc_id for r in langid.identify(asked, model).filter("lang = lang_pred").collect()}
    assert len(right) > 0.8 * asked.count()
    assert {r.doc_id for r in langid.keep_identified(asked, model).collect()} >= right
    # Decisions: languages that are not wanted go, and so do texts of no language; what is identified rightly stays.
    sure = model
    kept = {r.doc_id for r in langid.keep_identified(asked, sure, wanted=["l0"]).collect()}
    named = langid.identify(asked, sure)
    assert kept and kept == {r.doc_id for r in named.filter("lang_pred = 'l0'").collect()}
    still = {r.doc_id for r in langid.keep_identified(asked, sure).collect()}
    rightly = {r.doc_id for r in named.filter("lang = lang_pred and doc_id % 2 = 0").collect()}
    assert len(rightly - still) == 0
    unlabelled = langid.fit_languages(docs.withColumn("lang", F.lit(None).cast("string")))
    assert langid.keep_identified(asked, unlabelled).count() == asked.count()


def test_language_of_rare_letters_and_of_long_texts(spark, documents):
    """Two languages whose letters have no code of their own, and one whose documents are all long."""
    rng, rows = np.random.default_rng(12), []
    for k, first in enumerate((0x4E00, 0x5E00)):  # few characters each, beside a language with 150 letters
        letters = [chr(first + i) for i in range(80)]
        rows += [(100 * k + i, "".join(rng.choice(letters, 30)), f"rare{k}") for i in range(40)]
    common = [chr(0xAC00 + i) for i in range(150)]
    rows += [(200 + i, "".join(rng.choice(common, 3000)), "common") for i in range(40)]
    words = ["".join(rng.choice(list("abcdefg"), 5)) for _ in range(50)]
    rows += [(300 + i, " ".join(rng.choice(words, 5000)), "long") for i in range(12)]
    docs = documents(rows)
    model = langid.fit_languages(docs.filter("doc_id % 4 > 0"))
    assert model.classes == ["common", "long", "rare0", "rare1"]
    got = langid.identify(docs.filter("doc_id % 4 = 0"), model).collect()
    assert all(r.lang == r.lang_pred for r in got)


def test_packed_grams_have_the_codes_of_the_text():
    for letters in ("abcd", "ab"):
        grams = langid.Grams(letters)
        for text in ("ab abc", "  d, cab!! bad", "a"):
            assert set(grams.codes(text)) == set(grams.codes(langid.packed_grams(text)))
    assert len(set(langid.Grams("").codes("漢字語"))) == len(langid.packed_grams("漢字語")) == 11


def test_language_kernel_is_the_definition():
    model = langid.LanguageModel(["ab abc", "bcd"], "abcd")
    grams = lambda t: {t[i:i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}
    one, two = grams(" abca "), grams(" bcd ")
    k, _ = model.kernels(["abca"])
    assert k[0, 1] == pytest.approx(len(one & two) / math.sqrt(len(one) * len(two)), rel=1e-5)


def toxic_rows():
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abcdeghlnorstu"), rng.integers(3, 8))) for _ in range(400)]
    say = lambda: " ".join(rng.choice(words, 12)) + ". "
    rows = []
    for i in range(160):
        text = say() + say()
        if i % 4 == 0:
            text += " ".join(rng.choice(words, 3)) + " " + ["idiot", "moron"][i % 8 // 4] + " " + say()
        rows.append((i, text, int(i % 4 == 0)))
    return rows


def test_toxicity_edges(spark, documents):
    rows = toxic_rows()
    docs = documents([(i, t) for i, t, _ in rows])
    labels = spark.createDataFrame(
        [(i, y) for i, _, y in rows] + [(None, 1), (3, None), (0, 0)], "doc_id bigint, toxic int")
    model = toxicity.fit_toxicity(docs, labels)
    clean = rows[1][1]
    asked = [clean, f"{clean} you idiot!", f"{clean} you i.d.i.o.t", f"{clean} you i d i o t x", f"{clean} idiiot", None, "", "...",
             f"{clean * 2000} idiot idiot"]
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(documents(list(enumerate(asked)), extra=True), model).collect()}
    assert all(got[i] >= 0.3 for i in (1, 2, 3, 4)) and got[0] < 0.3
    assert got[5] == got[6] == got[7] < 0.3 and all(0 <= s <= 1 for s in got.values())
    assert got[8] > got[0]
    nothing = toxicity.fit_toxicity(docs, labels.limit(0))
    assert 0 <= toxicity.score_toxicity(documents([(1, "idiot")]), nothing).first().score < 0.3
    assert toxicity.score_toxicity(documents([]), model).count() == 0


def test_subsequence_kernel_is_the_definition():
    def features(word):
        out = Counter()
        w = f"^{word}$"
        for i in range(len(w)):
            for j in range(i + 1, min(i + 3, len(w))):
                for k in range(j + 1, min(j + 3, len(w))):
                    out[w[i] + w[j] + w[k]] += toxicity.DECAY ** (k - i - 2)
        return out
    kernel = lambda a, b: sum(v * b[x] for x, v in a.items())
    one, two = features("banana"), features("bandana")
    want = (kernel(one, two) / math.sqrt(kernel(one, one) * kernel(two, two))) ** toxicity.POWER
    got = toxicity.WordKernels(["bandana", "x"])(["banana", "bandana", "qqq"])
    assert got[0, 0] == pytest.approx(want, rel=1e-4) and got[1, 0] == pytest.approx(1) and got[2, 0] == 0


def area(scores, toxic):
    """Share of (toxic, clean) pairs in the right order, ties half."""
    scores, toxic = np.asarray(scores), np.asarray(toxic, bool)
    gap = scores[toxic][:, None] - scores[~toxic][None]
    return ((gap > 0) + 0.5 * (gap == 0)).mean()


CLEAN = "abcdefghijklmnoprstuvwz"
PROBES = {
    "one insult": (CLEAN, lambda rng, words: ["zorkling"]),
    "tail": (CLEAN, lambda rng, words: ["quibnark" if rng.random() < 0.05 else "zorkling"]),
    "two words, each common": (CLEAN, lambda rng, words: [words[3], words[8]]),
    "fixed phrase": (CLEAN, lambda rng, words: ["well", "you", "absolute", "zorkling", "today."]),
    "gaps and insertions": (CLEAN, lambda rng, words: [["zorkling", "z.o.r.k.l.i.n.g", "zorrkling", "zorklng"][rng.integers(4)]]),
    "another script": ("".join(chr(0x4E00 + i) for i in range(300)), lambda rng, words: ["侮辱者的"]),
}


@pytest.mark.parametrize("name", PROBES)
def test_toxicity_is_learned_whatever_its_form(name):
    letters, insult = PROBES[name]
    rng = np.random.default_rng(7)
    words = list({"".join(rng.choice(list(letters), rng.integers(2, 8))) for _ in range(600)})
    rank = 1 / np.arange(1, len(words) + 1)
    rows = []
    for i in range(560):
        run, toxic = [], bool(i % 3 == 0)
        for _ in range(rng.integers(3, 9)):
            sentence = list(rng.choice(words, rng.integers(4, 14), p=rank / rank.sum()))
            sentence = [w for k, w in enumerate(sentence) if k == 0 or (sentence[k - 1], w) != (words[3], words[8])]
            run.append(sentence)
        if toxic:
            at = run[rng.integers(len(run))]
            k = rng.integers(len(at) + 1)
            at[k:k] = insult(rng, words)
        rows.append((" ".join(" ".join(s) + "." for s in run), toxic))
    rng.shuffle(rows)
    rows = [(str(t), y in (True, "True")) for t, y in rows]
    model = toxicity.train(rows[:400])
    scores, toxic = model.scores([t for t, _ in rows[400:]]), np.array([y for _, y in rows[400:]])
    assert area(scores, toxic) >= 0.9 and (scores[~toxic] >= 0.3).mean() <= 0.1 and (scores[toxic] >= 0.3).mean() >= 0.8


def test_text_without_evidence_scores_no_more_than_the_share():
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list(CLEAN), 6)) for _ in range(300)]
    rows = [(" ".join(rng.choice(words, 20)), bool(i % 5 == 0)) for i in range(300)]  # labels say nothing
    model = toxicity.train(rows)
    assert (model.scores([t for t, _ in rows] + [""]) < 0.5).all()
    model = toxicity.train([(t + (" zorkling" if y else ""), y) for t, y in rows], share=0.02)
    assert model.scores([rows[1][0]])[0] < 0.05 and model.scores([""])[0] < 0.05 < model.scores(["a zorkling"])[0]
    one_class = toxicity.train([(t, True) for t, _ in rows], share=1.0)
    assert 0 <= one_class.scores(["x"])[0] <= 1


def test_toxicity_held_out(spark):
    """On the given labels; about one toxic text in eight holds none of the insults that the others have."""
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    kept_out = id_remainder("doc_id", 4) == 2
    model = toxicity.fit_toxicity(docs, labels.filter(~kept_out))
    known = labels.filter(kept_out & F.col("toxic").isNotNull()).select("doc_id", "toxic")
    got = toxicity.score_toxicity(docs.join(known, "doc_id").select("doc_id", "text", "toxic"), model).collect()
    scores, toxic = np.array([r.score for r in got]), np.array([r.toxic > 0 for r in got])
    assert area(scores, toxic) >= 0.9 and (scores[~toxic] >= 0.3).mean() <= 0.05 and (scores[toxic] >= 0.3).mean() >= 0.8


def test_elias_fano_levels(tmp_path):
    rng = np.random.default_rng(2)
    for n, top in ((1, 5), (10, 10), (5000, 10 ** 11), (300, 300)):
        values = np.sort(rng.integers(0, top, n))
        level = elias_fano.EliasFano(elias_fano.open_levels(elias_fano.pack_levels(
            elias_fano.EliasFano.build(values, "x"))), "x")
        asked = np.r_[values, rng.integers(0, top + 9, 200), 0, top + 3]
        at = level.find(asked)
        assert (at == np.searchsorted(values, asked)).all()
        assert (level.holds(asked, at) == np.isin(asked, values)).all()
    key = np.unique(rng.integers(0, 60 * 900, 4000))
    log = -rng.random(len(key)) * 6
    path = tmp_path / "trie"
    path.write_bytes(elias_fano.BigramTrie.build(key // 900, key % 900, log, 900))
    trie = elias_fano.BigramTrie(np.memmap(path, np.uint8, "r"))
    every = np.arange(70 * 900)
    codes = trie.lookup(every // 900, every % 900)
    assert (np.flatnonzero(codes) == key).all()
    back = trie.scale[0] + (codes[key].astype(float) - 1) * trie.scale[1]
    assert np.abs(back - log).max() <= trie.scale[1] / 2 + 1e-9
    none = elias_fano.BigramTrie(elias_fano.BigramTrie.build(*[np.zeros(0, int)] * 2, np.zeros(0), 9))
    assert none.lookup(np.array([1]), np.array([2])).tolist() == [0]


def brute_scores(rows, held):
    tokens = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + ["\0"] for _, t in rows]
    unigram, bigram = Counter(), Counter()
    for run, out in zip(tokens, held, strict=True):
        if out is False:
            unigram.update(run), bigram.update(zip(["\1", *run], run, strict=False))
    n, v = sum(unigram.values()), len(unigram)
    context = dict(unigram) | {"\1": sum(out is False for out in held)}
    result = []
    for (i, _), run, out in zip(rows, tokens, held, strict=True):
        base = sum(math.log10((unigram[w] + 1) / (n + v + 1)) for w in run)
        score = 0.0
        for before, w in zip(["\1", *run], run, strict=False):
            c, m = context.get(before, 0), language_model.PRIOR
            p = ((unigram[w] - 0.5 if unigram[w] else 0.5 * v) / n) if n else 1.0
            score += math.log10(bigram[before, w] / (c + m) + m / (c + m) * p)
        result.append((i, bool(out), len(run), sum(unigram[w] > 0 for w in run), n, base, score))
    return result


@pytest.mark.parametrize("block_tokens", [20, 1_000_000])
def test_language_model_is_the_brute_force(spark, documents, block_tokens):
    rows = [(i, f"The cat {'sat ' * (i % 4)}on\tthe mat {i % 5}") for i in range(40)]
    rows += [(90, None), (91, ""), (92, " \n "), (None, "the cat"), (3, rows[3][1]), (93, "É é Unseen\x0bwords " * 500)]
    held = [None if i is None else remainder(i, 7) == 2 for i, _ in rows]
    got = language_model.score_documents(
        documents(rows, extra=True), id_remainder("doc_id", 7) == 2, block_tokens).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[5])
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(brute_scores(rows, held), key=key), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], abs=1e-9)
        assert a[6] == pytest.approx(b[6], abs=0.02 * a[2])


def test_language_model_without_training_or_rows(spark, documents):
    one = language_model.score_documents(documents([(1, "a b")]), F.lit(True)).first()
    assert (one.n_tokens, one.n_known, one.train_tokens, one.base_score, one.score) == (3, 0, 0, 0.0, 0.0)
    assert language_model.score_documents(documents([]), F.lit(False)).count() == 0


def test_messages_of_the_language_model_come_back_and_are_small():
    rng = np.random.default_rng(6)
    words = np.unique(rng.integers(0, 1 << 64, 50_000, np.uint64))
    places = np.cumsum(rng.integers(1, 40, 50_000))
    for kind in (np.uint64, np.int64, np.uint8, np.float64):
        for size in (0, 1, 7):
            array = np.arange(size).astype(kind) * 99
            assert (language_model._unpack(language_model._pack(array)) == array).all()
            assert (language_model._unpack_sorted(language_model._pack_sorted(array), kind) == array).all()
    for array in (words, places):
        assert (language_model._unpack_sorted(language_model._pack_sorted(array), array.dtype.type) == array).all()
    assert len(language_model._pack_sorted(words)) < 6.8 * len(words)
    assert len(language_model._pack_sorted(places)) < 1.1 * len(places)
    tokens = np.minimum(rng.zipf(1.3, 50_000), 60_000) - 1
    assert len(language_model._pack(tokens)) < 0.95 * len(pa.compress(tokens.astype(np.uint16).tobytes(), "zstd"))
