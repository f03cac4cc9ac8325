"""Leaks, mixing and subject areas against brute force, round trips and held-out labels."""

import random
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
from conftest import rows

from strandloom.llm import areas as ar
from strandloom.llm import leaks as lk
from strandloom.llm import mixing as mx
from strandloom.llm.words import split_words

DROP = {0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF}


def brute_words(text):
    if text is None:
        return []
    t = "".join(c for c in unicodedata.normalize("NFKD", text) if unicodedata.category(c)[0] != "M" and ord(c) not in DROP)
    t = t.lower().replace("-\n", "")
    out, word = [], ""
    for c in t + " ":
        if c in "abcdefghijklmnopqrstuvwxyz0123456789":
            word += c
        elif word:
            out.append(word)
            word = ""
    return out


TEXTS = ["Épée-\nistes co­op  ﬁne!", "", "   ", None, "a", "-\n", "İstanbul Ünïcode x²", "tab\tnew\r\nline-\r\nkept", "é" * 3, "日本 go"]


def test_words():
    flat, counts = split_words(pa.array(TEXTS))
    got, at = [], 0
    for n in counts:
        got.append(flat[at : at + n].to_pylist())
        at += n
    assert got == [brute_words(t) for t in TEXTS]
    assert split_words(pa.array([], pa.string()))[0].to_pylist() == []


def runs_of(words, n):
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def longest(a, b):
    best, row = 0, [0] * (len(b) + 1)
    for x in a:
        row = [0] + [row[j] + 1 if x == y else 0 for j, y in enumerate(b)]
        best = max(best, *row)
    return best


def brute_leaks(docs, items):
    out = []
    for d, text in docs:
        if d is None:
            continue
        w = brute_words(text)
        for i, item in sorted(set(items), key=str):
            v = brute_words(item)
            own = runs_of(v, 4)
            n, shared = longest(v, w) if v and w else 0, len(own & runs_of(w, 4))
            if n >= 13 or (own and 2 * shared >= len(own)):
                out.append((d, i, n if n >= 13 else 0, shared, len(own)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block,shard", [(2000, 8 << 20), (2, 200)])
def test_leaks(spark, block, shard):
    rng = random.Random(block)
    vocabulary = [f"w{i}" for i in range(12)]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, say(rng.choice([1, 3, 4, 5, 14, 30, 40]))) for i in range(12)] + [(50, None), (51, ""), (52, "unheard of words only here")]
    items += [(60, items[5][1]), items[0]]
    docs = []
    for d in range(60):
        parts = [say(rng.randrange(0, 30)), "strange"]
        if d % 3 == 0:
            w = rng.choice(items[:12])[1].split()
            a = rng.randrange(0, max(1, len(w) - 3))
            parts.insert(rng.randrange(3), " ".join(w[a : a + rng.choice([4, 12, 13, 14, 40])]))
        docs.append((d, rng.choice([" ", "\n", ", "]).join(parts)))
    docs += [(100, None), (101, ""), (None, items[4][1]), (102, " ".join(v or "" for _, v in items)), (103, (say(13) + " ") * 300)]
    got = lk.leaks(spark.createDataFrame([(*r, 1) for r in docs], "doc_id bigint, text string, item_id int"), spark.createDataFrame([(*r, 2) for r in items], "item_id bigint, item_text string, doc_id int"), block=block, shard_bytes=shard)
    assert rows(got.select("doc_id", "item_id", "longest", "shared_runs", "item_runs")) == brute_leaks(docs, items)
    texts, asked = dict(docs), dict(items)
    for r in got.filter("longest > 0").collect():
        assert brute_words(texts[r.doc_id])[r.doc_word : r.doc_word + r.longest] == brute_words(asked[r.item_id])[r.item_word : r.item_word + r.longest]


def test_leaks_of_many_words(spark):
    """More words in a block of items than 16 bits can number."""
    rng = random.Random(8)
    item = " ".join(f"w{i}" for i in range(70_000))
    cut = item.split()[60_000:60_020]
    docs = [(1, "x " + " ".join(cut) + " y"), (2, " ".join(rng.sample(cut, 20))), (3, "w69999 w1 w2 w3 w4")]
    items = [(1, item), (2, "w1 w2 w3 w4"), (3, " ".join(cut[5:]))]
    got = lk.leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, item_text string"))
    assert rows(got.select("doc_id", "item_id", "longest", "item_word")) == [(1, 1, 20, 60_000), (1, 3, 15, 0), (3, 2, 0, None)]


def test_leaks_of_nothing(spark):
    docs = spark.createDataFrame([(1, "a b c d e")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "a b c d")], "item_id bigint, item_text string")
    assert rows(lk.leaks(docs, items).select("doc_id", "item_id", "longest")) == [(1, 1, 0)]
    assert rows(lk.leaks(docs.limit(0), items)) == [] == rows(lk.leaks(docs, items.limit(0)))
    parts = lk.leaks(docs, spark.createDataFrame([(i, "a b c d") for i in range(7)], "item_id bigint, item_text string"), most_bytes=14)
    assert [r[1] for r in rows(parts)] == list(range(7))


# -- mixing --------------------------------------------------------------------------------------------------------------
def test_exponents():
    assert mx.weights([0.9, 0.1], 0) == [0.5, 0.5]
    assert mx.weights([0.9, 0.1], 1) == pytest.approx([0.9, 0.1])
    assert mx.weights([1.0, 0.0], 0.5) == [1.0, 0.0]
    a = mx.exponent_for_limit(0.5, 100, 2, 1000)
    assert mx.on_path(0.5, 0.1, a) * 1000 == pytest.approx(200, rel=1e-6)
    assert mx.exponent_for_limit(0.5, 500, 1, 1000) == 0
    assert mx.exponent_for_limit(0.5, 0, 9, 1000) > 0 == mx.exponent_for_limit(0.0, 0, 9, 1000)
    b = mx.exponent_for_entropy([900, 90, 10], 0.8)
    assert mx.entropy(mx.weights([0.9, 0.09, 0.01], b)) == pytest.approx(0.8, abs=1e-6)


def test_shortfalls_go_to_those_who_can_give():
    """Brute force: filling up in proportion to targets, each to its limit."""
    rng = random.Random(6)
    for _ in range(200):
        k = rng.randrange(1, 6)
        tokens, limits = [rng.choice([0, 5, 100, 900]) for _ in range(k)], [rng.choice([0, 1, 3, 8]) for _ in range(k)]
        raw = [rng.random() for _ in range(k)]
        targets = [x / sum(raw) for x in raw]
        total = sum(tokens) + rng.choice([0, 50])
        _, shares = mx.tempered(targets, tokens, limits, total)
        want, free = [0.0] * k, set(range(k))
        while free and total:
            scale = (1 - sum(want[i] for i in range(k) if i not in free)) / sum(targets[i] for i in free)
            full = {i for i in free if scale * targets[i] * total > limits[i] * tokens[i]}
            for i in full or free:
                want[i] = limits[i] * tokens[i] / total if full else scale * targets[i]
            if not full:
                break
            free -= full
        assert shares == pytest.approx(want, rel=1e-6, abs=1e-9)


def counted(spark, data):
    return spark.createDataFrame(data, "doc_id bigint, source string, n_tokens bigint")


def test_plan_and_mix(spark):
    rng = random.Random(3)
    spellings = ["big_one", "Big One", " big-one ", "BIG_ONE"]
    data = [(i, rng.choice(spellings), rng.randrange(0, 50)) for i in range(3000)] + [(5000 + i, "small", 10) for i in range(30)] + [(9000 + i, rng.choice([None, "other"]), 5) for i in range(100)] + [(None, "small", 3)]
    targets = spark.createDataFrame([("big_one", 0.3, 2), ("Small", 0.6, 3), ("void", 0.1, 9), ("broken", None, None)], "source string, target_share double, max_repeats bigint")
    df = counted(spark, data)
    plan = mx.plan(df, targets)
    total, small = sum(r[2] for r in data), 303
    got = {r.written: r for r in plan.collect()}
    assert got["Small"].tokens == small and got["Small"].all_tokens == total
    assert {k: r.binds for k, r in got.items()} == {"big_one": False, "Small": True, "void": True, "broken": False}
    chosen = mx.realise(df, plan, blocks=16).collect()
    assert len({r.doc_id for r in chosen}) == len(chosen)
    given = {}
    for r in chosen:
        given[r.source] = given.get(r.source, 0) + r.n_tokens * r.repeats
    assert given["small"] == 3 * 300 and all(r.repeats == 3 for r in chosen if r.source == "small")
    # The others can't reach 0.7 of all tokens, so what they leave comes from the big one, within its limit.
    budget = total - 3 * small
    assert got["big_one"].budget in (budget - 1, budget) and budget - 50 < given["big_one"] <= budget
    assert got["big_one"].tempered_share == pytest.approx(1 - 3 * small / total) and sum(r.tempered_share for r in got.values()) == pytest.approx(1)
    kept = {r.written: r.budget for r in mx.plan(df, targets, kind="target").collect()}
    assert kept == {"big_one": int(0.3 * total), "Small": 3 * small, "void": 0, "broken": 0}
    assert max(r.repeats for r in chosen if r.source == "big_one") - min(r.repeats for r in chosen if r.source == "big_one") <= 1


def test_mix_of_nothing(spark):
    targets = spark.createDataFrame([("a", 0.5, 1)], "source string, target_share double, max_repeats bigint")
    empty = counted(spark, [])
    assert [(r.tokens, r.all_tokens, r.binds) for r in mx.plan(empty, targets).collect()] == [(0, 0, False)]
    assert rows(mx.realise(empty, mx.plan(empty, targets))) == []
    assert rows(mx.plan(counted(spark, [(1, "a", 5)]), targets.limit(0))) == [] == rows(mx.plan(empty, targets.limit(0)))


def test_budgets_keep_to_the_limits(spark):
    df = counted(spark, [(i, "a", 10) for i in range(100)] + [(1000 + i, "b", 10) for i in range(10)])
    targets = spark.createDataFrame([("a", 0.2, 1), ("b", 0.8, 4)], "source string, target_share double, max_repeats bigint")
    plan = {r.source: r for r in mx.plan(df, targets).collect()}
    assert plan["b"].budget in (399, 400) and plan["a"].budget in (699, 700) and plan["a"].passes == 0
    assert plan["a"].exponent == 0 < plan["b"].exponent < 1
    for r in mx.plan(df, targets, kind="entropy").collect():
        assert r.budget <= r.max_repeats * r.tokens and r.budget <= r.entropy_share * 1100
    with pytest.raises(ValueError, match="kind"):
        mx.plan(df, targets, kind="none")


def test_token_counts(spark):
    texts = ["hello world", "", None, "<|endoftext|>", "word " * 20_000, "ACGT" * 5000, "​ naïve"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.n_tokens for r in mx.with_tokens(df, "text", ["doc_id"]).collect()}
    assert got[0] == 2 and got[1] == 0 == got[2] and got[3] > 1 and got[4] == 20_001
    encode = mx._encoding(mx.TOKENIZER, mx.PATTERN)
    for i, t in enumerate(texts):
        assert t is None or encode.decode(encode.encode_ordinary(t)) == t
        assert got[i] == (len(encode.encode_ordinary(t)) if t else 0)


# -- areas ---------------------------------------------------------------------------------------------------------------
WORDS = {"law": ["clause", "treaty", "liability", "court", "statute", "waiver", "remedy"], "bio": ["gene", "allele", "locus", "mutant", "intron", "gamete", "meiosis"], "sport": ["goal", "match", "referee", "league", "stadium", "penalty", "coach"]}


def corpus(n, rng):
    docs, truth = [], {}
    for i in range(n):
        about = rng.sample(sorted(WORDS), rng.choice([1, 1, 2]))
        said = [f"It matters whether the {rng.choice(WORDS[s])} and the {rng.choice(WORDS[s])} of the {rng.choice(WORDS[s])} hold{rng.choice('.?!')}" for s in about for _ in range(4)]
        other = rng.choice(sorted(set(WORDS) - set(about)))
        said.append(f"It matters whether the {rng.choice(WORDS[other])} and the {rng.choice(WORDS[other])} hold.")
        said += ["Thanks to everyone who replied.", "[10:22:01] step 3/25 done", "ACGTACGTTAGACCA"]
        rng.shuffle(said)
        docs.append((i, " ".join(said), "en"))
        truth[i] = set(about)
    return docs, truth


def test_areas(spark):
    docs, truth = corpus(300, random.Random(4))
    docs += [(900, None, "en"), (901, "", None), (902, "Thanks to everyone who replied.", "en"), (None, docs[0][1], "en"), (903, docs[0][1].upper(), "xx"), (904, docs[0][1] + " Thanks to everyone who replied." * 5000, "en")]
    labels = [(d, s.upper() if d % 2 else f" {s} ") for d, ss in truth.items() for s in sorted(ss) if d < 150] + [(3, None), (4, "unheard of"), (99999, "law"), (None, "law")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string")
    lab = spark.createDataFrame(labels, "doc_id bigint, subject string")
    sub = spark.createDataFrame([("law", "Law", "courts"), ("bio", "Biology", "genes"), ("sport", "Sport", None)], "subject string, title string, description string")
    got = {}
    for r in ar.areas(df, lab, sub).collect():
        assert r.subject not in got.setdefault(r.doc_id, set())
        got[r.doc_id].add(r.subject)
    held_out = [d for d in truth if d >= 150]
    assert np.mean([got.get(d) == truth[d] for d in held_out]) > 0.95
    assert 900 not in got and 901 not in got and 902 not in got and None not in got
    assert got[903] == got[0] == got[904]


def test_areas_without_anything_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some text. more text.")], "doc_id bigint, text string")
    lab = spark.createDataFrame([], "doc_id bigint, subject string")
    sub = spark.createDataFrame([("law", "Law", "courts")], "subject string, title string, description string")
    assert rows(ar.areas(docs, lab, sub)) == [] == rows(ar.areas(docs, lab, sub.limit(0))) == rows(ar.areas(docs.limit(0), lab, sub))


def test_sentences():
    s = ar.sentences(pa.array(["One two. Three! Four?\n\nFive six", "", "LostBlanks.AreParted"]))
    got = {}
    for t, n in zip(s.term, s.sentence, strict=True):
        got.setdefault(n, []).append(s.terms[int(t)].as_py())
    assert list(got.values()) == [["one", "two"], ["three"], ["four"], ["five", "six"], ["lost", "blanks"], ["are", "parted"]]


def test_speller_forgives_one_letter():
    find = ar.Speller(["genome", "allele", "locus", "genomes"], 6)
    words = ["genome", "gename", "genme", "geenome", "gneome", "genomes", "gxnxme", "locus", "lacus", "alleles", "", "x" * 5000, "日本"]
    assert find(pa.array(words, pa.large_string())).tolist() == [0, 0, 0, 0, 0, 3, -1, 2, -1, 1, -1, -1, -1]
    assert ar.Speller([], 6)(pa.array(["genome"], pa.large_string())).tolist() == [-1]
