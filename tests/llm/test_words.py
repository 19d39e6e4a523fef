"""Spelling variants, toxicity, phrases and the filters that count them."""

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import phrases, spelling, toxicity
from millrace.llm.quotient_filter import Filter, permute, restore


def table(spark, rows, schema, more="word string, n string, key string, score string"):
    width = len(more.split(","))
    return spark.createDataFrame([(*r, *["x"] * width) for r in rows], f"{schema}, {more}")


# spelling variants


def edits(word, letters):
    cuts = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    out = {a + b[1:] for a, b in cuts if b} | {a + c + b for a, b in cuts for c in letters} | {a + c + b[1:] for a, b in cuts if b for c in letters}
    return out - {word}


def expected_variants(counts, min_length, min_count, ratio):
    words = {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}
    letters = set("".join(words))
    near = {w: edits(w, letters) & set(words) for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= ratio * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return out


@pytest.mark.parametrize("large", [2, 2000])
def test_variants_against_all_edits(spark, large):
    draw = random.Random(3)
    base = ["".join(draw.choice("abé") for _ in range(draw.randrange(5, 9))) for _ in range(120)] + ["aaaaaaa", "a" * 400, "a" * 399 + "b"]
    words = set(base)
    for w in base:
        words |= set(draw.sample(sorted(edits(w, "abéz")), 2))
    counts = {w: draw.choice([1, 2, 3, 25, 400, 5000]) for w in words}
    rows = spark.createDataFrame([*counts.items(), (None, 5), ("nothing", None)], "word string, n bigint")
    got = spelling.group_variants(rows, 5, 2, large=large)
    assert {tuple(r) for r in got.collect()} == expected_variants(counts, 5, 2, spelling.RATIO)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_words_of_documents(spark):
    rows = [(1, "Straße NAÏVE naïve don't x2y ÀB"), (1, "Straße"), (None, "letter Letter"), (2, None), (3, ""), (4, "1 2 _ 日本"), (5, "mot " * 600_000 + "é" * 1000)]
    got = {r["word"]: r["n"] for r in spelling.count_words(table(spark, rows, "doc_id bigint, text string")).collect()}
    want = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            want[run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    assert got == {w: n for w, n in want.items() if w}
    empty = table(spark, [], "doc_id bigint, text string")
    assert spelling.document_variants(empty).collect() == []


# toxicity


@pytest.mark.parametrize("given, want", [
    ("You are an 1d1ot, m0r0n!", " you are an idiot moron "), ("$tupid tr@sh 5tuff b@d", " stupid trash stuff bad "),
    ("ѕсum іdіоt", " scum idiot "), ("сосна Дождь", " cocha дождь "), ("12.5 x86 $5 a@1", " 12 5 x86 5 a 1 "),
    ("ｔｒａｓｈ tr​ash", " trash trash "), ("a\nb_c", " a \n b c "), ("", "  "), ("Éa ß", " éa ß "),
])
def test_folding(given, want):
    assert toxicity.fold(given)[0] == want


def test_exceptions_spare_what_they_hold():
    lexicon = toxicity.Lexicon([(" kill", 2.0), (" killer ", 3.0), (" scum ", 1.0)], [" kill the process ", " scum bag "])
    assert lexicon.weigh("kill the process, killer scum") == (4.0, 2, 5)
    assert lexicon.weigh("kill the\nprocess") == (2.0, 1, 3)
    assert lexicon.weigh("scum bag") == (0.0, 0, 2) and lexicon.weigh("") == (0.0, 0, 0)
    assert toxicity.Lexicon([], []).weigh("killer") == (0.0, 0, 1)


def test_long_texts_weigh_the_same_in_pieces(monkeypatch):
    lexicon = toxicity.Lexicon([(" bad", 2.0)], [" not bad "])
    text = "a bad line\nnot bad here\n" * 500
    whole = lexicon.weigh(text)
    monkeypatch.setattr(toxicity, "CHUNK_CHARS", 10)
    assert lexicon.weigh(text) == whole == (1000.0, 500, 3000)


def speech(spark):
    draw = random.Random(5)
    plain = [f"{a}{b}" for a in ("ta", "ri", "mo", "le", "su") for b in ("na", "ko", "vi", "pe")]
    docs, labels = [], []
    for i in range(1500):
        toxic = i % 10 == 0
        words = [draw.choice(plain) for _ in range(draw.randrange(5, 80))]
        if toxic:
            words[0] = draw.choice(["gunk", "gunky", "gunks", "Sl1me", "slime"])
        elif i % 30 == 1:
            words[1:3] = ["gunk", "cleaner"]
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    odd = [(9000, None), (9001, ""), (None, "gunky slime"), (9002, "tana riko " * 200_000 + "gunky slimes"), (9003, "gunk cleaner"), (9003, "gunk cleaner"), (9004, "ѕlimе gunks")]
    return table(spark, docs + odd, "doc_id bigint, text string"), spark.createDataFrame([*labels, (None, 1), (3, None), (7, 5), (99999, 1)], "doc_id bigint, toxic int")


def test_toxicity_is_learned(spark):
    docs, labels = speech(spark)
    got = toxicity.judge(docs, labels).collect()
    assert len(got) == 1507 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    said = defaultdict(set)
    for r in got:
        said[r["doc_id"]].add((r["predicted"], r["score"]))
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    wrong = [i for i in range(1500) if next(iter(said[i]))[0] != int(i % 10 == 0)]
    assert len(wrong) <= 5
    assert said[9000] == said[9001] and next(iter(said[9000]))[0] == 0 and len(said[9003]) == 1 and next(iter(said[9003]))[0] == 0
    assert next(iter(said[None]))[0] == next(iter(said[9004]))[0] == 1
    again = {r["doc_id"]: r["score"] for r in toxicity.judge(docs.repartition(3), labels.repartition(5)).collect()}
    assert all(abs(again[i] - next(iter(said[i]))[1]) < 1e-9 for i in range(1500))


def test_toxicity_without_labels(spark):
    docs, labels = speech(spark)
    assert {r["score"] for r in toxicity.judge(docs, labels.limit(0)).collect()} == {0.0}
    assert {r["predicted"] for r in toxicity.judge(docs, labels.where("toxic = 1")).collect()} == {1}
    assert toxicity.judge(docs.limit(0), labels).collect() == []


# quotient filters


@pytest.mark.parametrize("width, size", list(itertools.product([16, 33, 64], [2, 3, 5])))
def test_filters_lose_nothing(width, size):
    rng = np.random.default_rng(width)
    pool = [rng.integers(0, (1 << width) - 1, 200, np.uint64, endpoint=True) for _ in range(size)]
    which = rng.integers(0, 200, 4000) ** 2 // 200
    grams = [p[which] for p in pool]
    numbers = permute(grams, width)
    assert all((a == b).all() for a, b in zip(restore(numbers, width), grams))
    one = Filter.of(numbers, np.ones(4000, np.int64), width)
    both = Filter.merged([one, Filter.of([x[:100] for x in numbers], np.full(100, 10**10), width)])
    want = Counter(zip(*[g.tolist() for g in grams]))
    for gram in zip(*[g[:100].tolist() for g in grams]):
        want[gram] += 10**10
    for bits in (0, 5, 16):
        parts = [Filter.unpack(packed) for _, packed in both.pack(bits)]
        found = Counter()
        for f in parts:
            found.update(dict(zip(zip(*[g.tolist() for g in f.grams()]), f.counts.tolist())))
        assert found == want


# phrases


def expected_phrases(rows, longest, least, percent, top):
    one, f, size = defaultdict(Counter), defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            size[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang in f:
        cands = {p: a for p, a in f[lang].items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in cands.items():
            inside = [q for q in cands if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if any(100 * cands[q] >= percent * a for q in inside):
                continue
            score, k = min((10**6 * a * a // (f[lang][p[:k]] * f[lang][p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), a, f[lang][p[:k]], f[lang][p[k:]], size[lang], score))
        for rank, r in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, r[2].decode(), *r[3:]))
    return sorted(out)


def chatter(n=400):
    draw = random.Random(11)
    words = ["Ab", "ab", "ça", "x'y", "d e", "f", "g", "-", "日本", "😀"]
    rows = []
    for i in range(n):
        text = "".join(draw.choice(words) + draw.choice([" ", " ", " ", "\t", ". ", "\n", ",", "  "]) for _ in range(draw.randrange(0, 40)))
        rows.append((draw.choice(["en", "de", None, "und", ""]), text + draw.choice(["", " New York City", " new york", "\r"])))
    return rows + [("en", None), ("en", ""), ("xx", "only once"), rows[0], rows[0]]


@pytest.mark.parametrize("longest, top", [(2, 2000), (3, 2000), (4, 7)])
def test_phrases_against_counting(spark, longest, top):
    rows = chatter()
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], "lang string, text string, word string, n string")
    got = phrases.collocations(docs, longest, 10, 50, top)
    assert sorted(map(tuple, got.collect())) == expected_phrases(rows, longest, 10, 50, top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_phrases_in_pieces_and_many_filters(spark, monkeypatch):
    for name, value in (("CHUNK_BYTES", 50), ("HELD", 5), ("PENDING", 20), ("ENTRIES", 10), ("MAP_BITS", 6)):
        monkeypatch.setattr(phrases, name, value)
    rows = chatter(60) + [("en", "a long line without an end " * 2000)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert sorted(map(tuple, phrases.collocations(docs, 3, 10, 50, 50).collect())) == expected_phrases(rows, 3, 10, 50, 50)


def test_words_with_equal_ids_are_told_apart(spark, monkeypatch):
    """A family of hashes in which all words collide is not taken."""
    honest = phrases._letters
    bad = np.where(honest(0) > 0, 1, 0).astype(np.uint16)
    monkeypatch.setattr(phrases, "_letters", lambda seed: honest(seed) if seed else bad)
    docs = spark.createDataFrame(chatter(50), "lang string, text string")
    vocabulary = phrases.Vocabulary.of(docs, 2)
    assert vocabulary.seed == 1 and vocabulary.words.count() == vocabulary.words.select("id").distinct().count()


def test_no_phrases(spark):
    none = spark.createDataFrame([], "lang string, text string")
    assert phrases.collocations(none).collect() == []
    assert phrases.collocations(spark.createDataFrame([("en", None), (None, "... ,")], "lang string, text string")).collect() == []


def test_scores_beyond_64_bits(spark):
    row = spark.sql("SELECT 900000000000000 AS a, 950000000000000 AS l, 999999999999999 AS r").select(phrases._score(F.col("a"), F.col("l"), F.col("r")).alias("s")).first()
    assert row["s"] == 10**6 * 900000000000000**2 // (950000000000000 * 999999999999999)
