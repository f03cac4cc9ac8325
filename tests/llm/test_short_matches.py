"""The longest match of leaks that only the rule of four-word runs finds."""

import random

from conftest import rows
from test_corpus import brute_words, longest

from strandloom.llm import leaks as lk


def test_short_matches(spark):
    rng = random.Random(4)
    say = lambda n: " ".join(rng.choice("abcdefg") for _ in range(n))
    items = [(i, say(n)) for i, n in enumerate([4, 5, 8, 12, 14, 30])]
    docs = [(d, say(rng.randrange(60)) + " strange " + items[d % 6][1].replace("a b", "a and b")) for d in range(40)]
    d, i = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, item_text string")
    got, before = lk.leaks(d, i, block=4, shard_bytes=300, short=True), lk.leaks(d, i)
    assert rows(got.select("doc_id", "item_id", "shared_runs")) == rows(before.select("doc_id", "item_id", "shared_runs"))
    texts, asked, short = dict(docs), dict(items), 0
    for r in got.collect():
        v, w = brute_words(texts[r.doc_id]), brute_words(asked[r.item_id])
        assert r.longest == longest(v, w) >= 4 and v[r.doc_word : r.doc_word + r.longest] == w[r.item_word : r.item_word + r.longest]
        short += r.longest < 13
    assert short > 20
