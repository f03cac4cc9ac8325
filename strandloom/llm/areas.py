"""Subject areas of documents, sentence by sentence, in a latent space with seed centroids.

Terms are weighted by inverse document frequency over the whole corpus and by how unevenly they are spread over the subjects
of labelled documents (1 - entropy), so the words of phrases that go with any subject weigh nothing. A truncated singular value
decomposition of the labelled sentences gives the latent space. Each subject has one seed centroid for each language, from the
labelled documents and the subject's own description; the centroids are refined by assigning the labelled sentences to the
nearest centroid of their document's subjects until nothing moves. A sentence belongs to the subject of the centroid nearest by
cosine, if its projection on that centroid is long enough; otherwise it deals with no area. Words count for the term that they
are but for one letter, since texts are mistyped and misread.

The model is fitted on the driver from a bounded sample of labelled documents. Document frequencies, the assignment and all
counts cover every document; a document is read and decided where it lies, so nothing is shuffled but term counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandloom.llm.words import folded, with_bytes
from strandloom.session import bounded_rows

_TERM_BYTES = bytes(c if 97 <= c <= 122 or c == 124 else 32 for c in range(256))
SENTENCE_END = r"""[.!?]+["')\]]*(\s|$)|\n\s*\n"""


@dataclass
class Settings:
    """``most_labelled`` and ``most_chars`` bound the sample of labelled documents (how many, how long); the rest shapes the model."""

    most_labelled: int = 4000
    most_chars: int = 100_000
    most_terms: int = 4000
    least_documents: int = 5
    least_weight: float = 0.05
    smoothing: float = 5.0
    dimensions: int = 96
    iterations: int = 12
    rounds: int = 10
    near: float = 0.3
    long_enough: float = 0.2
    least_letters: int = 6
    least_sentences: int = 2
    least_share: tuple[int, int] = (1, 6)


@dataclass
class Sentences:
    """Terms of texts: term number, text and sentence of each, in order; ``terms`` are the different terms."""

    terms: pa.Array
    term: np.ndarray
    text: np.ndarray
    sentence: np.ndarray
    of_sentence: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))


def sentences(texts: pa.Array) -> Sentences:
    """Sentences end at . ! or ? before a blank, or at an empty line. Words that lost the blanks between them are parted at capitals."""
    texts = pc.replace_substring_regex(texts.cast(pa.large_string()), r"([.!?,;:]|\p{Ll})(\p{Lu}\p{Ll})", r"\1 \2")
    marked = pc.replace_substring_regex(pc.replace_substring(folded(pc.fill_null(texts.cast(pa.large_string()), "")), "|", " "), SENTENCE_END, " | ")
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(with_bytes(marked, _TERM_BYTES)))
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = pc.list_flatten(lists).dictionary_encode()
    terms = coded.dictionary.cast(pa.large_string())
    term = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    text = np.repeat(np.arange(len(texts)), counts)
    if not len(term):
        return Sentences(terms, term, text, term)
    stop = np.isin(term, np.flatnonzero(np.isin(np.array(terms.to_pylist(), object), ["|", ""])))
    number = np.cumsum(stop | np.append(True, text[1:] != text[:-1]))
    term, text, number = term[~stop], text[~stop], number[~stop]
    first = np.append(True, number[1:] != number[:-1]) if len(number) else np.zeros(0, bool)
    return Sentences(terms, term, text, np.cumsum(first) - 1, text[first])


class Speller:
    """Finds the known term that a word is, or is with one letter wrong, missing or too many, or with two neighbours exchanged.

    Words and terms under ``least`` letters must agree. Of several terms near a word the first in the list counts, a wrong letter
    before a missing one before one too many before an exchange.
    """

    def __init__(self, terms: list[str], least: int):
        self.terms, self.least = pa.array(terms, pa.large_string()), least
        self.number: dict[str, int] = {}
        self.gaps: dict[str, int] = {}
        self.less: dict[str, int] = {}
        self.answers: dict[str, int] = {}
        for k, t in enumerate(terms):
            if len(t) >= least:
                self.number.setdefault(t, k)
                for i in range(len(t)):
                    self.gaps.setdefault(f"{t[:i]}_{t[i + 1 :]}", k)
                    self.less.setdefault(t[:i] + t[i + 1 :], k)

    def near(self, word: str) -> int:
        cuts = range(len(word))
        for table, forms in ((self.gaps, [f"{word[:i]}_{word[i + 1 :]}" for i in cuts]), (self.less, [word]), (self.number, [word[:i] + word[i + 1 :] for i in cuts]), (self.number, [word[:i] + word[i + 1] + word[i] + word[i + 2 :] for i in cuts[:-1]])):
            if found := table.keys() & forms:
                return min(table[f] for f in found)
        return -1

    def asked(self, word: str) -> int:
        """``near``, which a task works out once for a word; a million answers are kept."""
        if (k := self.answers.get(word)) is None:
            if len(self.answers) >= 1_000_000:
                self.answers.clear()
            k = self.answers[word] = self.near(word)
        return k

    def __call__(self, words: pa.Array) -> np.ndarray:
        """The number of the term of each word, -1 for none."""
        known = pc.fill_null(pc.index_in(words, value_set=self.terms), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        size = pc.utf8_length(words).to_numpy(zero_copy_only=False)
        longest = pc.max(pc.utf8_length(self.terms)).as_py() if len(self.terms) else 0
        asked = np.flatnonzero((known < 0) & (size >= self.least - 1) & (size <= (longest or 0) + 1))
        if len(asked):
            known = known.copy()
            known[asked] = [self.asked(w) for w in words.take(pa.array(asked)).to_pylist()]
        return known


@dataclass
class Model:
    """The terms as a speller, their pull on each centroid (terms x centroids), the subject of each centroid, and the least pull of a sentence."""

    speller: Speller
    pull: np.ndarray
    subject: np.ndarray
    least: float


def subject_codes(labels: DataFrame, subjects: DataFrame) -> tuple[list[str], DataFrame]:
    """The codes, and (doc_id, subject number) of labels that name a code or title in any case and with outer blanks."""
    rows = sorted(bounded_rows(subjects.filter("subject is not null").select("subject", "title"), 10_000, "subjects"))
    codes = [r[0] for r in rows]
    names = {name.strip().lower(): i for i, r in enumerate(rows) for name in (r[1], r[0]) if name}
    if not names:
        return codes, labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.lit(None).cast("int").alias("k")).limit(0)
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return codes, labels.filter("doc_id is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), table[F.trim(F.lower("subject"))].alias("k")).filter("k is not null").distinct()


def document_frequencies(documents: DataFrame, terms: list[str]) -> tuple[np.ndarray, int]:
    """In how many of all documents each term stands, and how many documents have a text."""
    vocabulary = pa.array(terms, pa.large_string())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(len(terms), np.int64), 0
        for batch in batches:
            s = sentences(batch.column(0))
            known = pc.fill_null(pc.index_in(s.terms, value_set=vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            term = known[s.term] if len(s.term) else s.term
            pairs = np.unique(term[term >= 0] * batch.num_rows + s.text[term >= 0])
            total += np.bincount(pairs // max(1, batch.num_rows), minlength=len(terms))
            n += batch.num_rows
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(seen, -1)), pa.array(np.append(total[seen], n))], names=["term", "n"])

    counted = documents.select("text").filter("text is not null").mapInArrow(count, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()
    df, n = np.zeros(len(terms), np.int64), 0
    for term, k in counted:
        if term < 0:
            n = k
        else:
            df[term] = k
    return df, n


def _gram(term: np.ndarray, start: np.ndarray, size: np.ndarray, value: np.ndarray, n: int, block: int = 20_000) -> np.ndarray:
    """X'X of sparse rows given by (term, value) runs."""
    out = np.zeros(n * n)
    for a in range(0, len(start), block):
        s, k = start[a : a + block], size[a : a + block]
        each = k * k
        at = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        base, width = np.repeat(s, each), np.repeat(k, each)
        i, j = base + at // width, base + at % width
        out += np.bincount(term[i] * n + term[j], weights=value[i] * value[j], minlength=n * n)
    return out.reshape(n, n).astype(np.float32)


def _row_sums(rows: np.ndarray, sentence: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros((n, rows.shape[1]), np.float32)
    if len(sentence):
        first = np.flatnonzero(np.append(True, sentence[1:] != sentence[:-1]))
        out[sentence[first]] = np.add.reduceat(rows, first, axis=0)
    return out


def fit(texts: list[str], langs: list[str], marks: np.ndarray, descriptions: list[str], frequencies, settings: Settings) -> Model:
    """The model from labelled texts; ``marks`` (texts x subjects) are their labels, ``frequencies(terms)`` the corpus counts."""
    n_subjects = marks.shape[1]
    empty = Model(Speller([], settings.least_letters), np.zeros((0, 0), np.float32), np.zeros(0, np.int64), 0.0)
    s = sentences(pa.array([*texts, *descriptions], pa.large_string()))
    marks = np.vstack([marks, np.eye(n_subjects)])
    langs = [*langs, *[""] * n_subjects]
    shares = marks / np.maximum(marks.sum(1, keepdims=True), 1)
    if not len(s.term) or not n_subjects:
        return empty
    pairs = np.unique(s.term * len(langs) + s.text)
    in_term, in_text = pairs // len(langs), pairs % len(langs)
    spread = np.zeros((len(s.terms), n_subjects))
    np.add.at(spread, in_term, shares[in_text])
    spread /= np.maximum(shares.sum(0), 1e-9) / max(shares.sum(0).mean(), 1e-9)
    chance = (spread + settings.smoothing / n_subjects) / (spread.sum(1, keepdims=True) + settings.smoothing)
    uneven = 1 + (chance * np.log(chance)).sum(1) / np.log(max(2, n_subjects))
    documents = np.bincount(in_term, minlength=len(s.terms))
    good = np.flatnonzero((documents >= settings.least_documents) & (uneven >= settings.least_weight))
    good = good[np.argsort(-documents[good] * uneven[good], kind="stable")][: settings.most_terms]
    if not len(good):
        return empty
    terms = [s.terms[int(i)].as_py() for i in good]
    df, n = frequencies(terms)
    weight = uneven[good] * np.log(np.maximum(n, 2) / np.maximum(df, 1))
    speller = Speller(terms, settings.least_letters)
    term = speller(s.terms)[s.term]
    there = term >= 0
    term, sentence = term[there], s.sentence[there]
    value = weight[term]
    first = np.flatnonzero(np.append(True, sentence[1:] != sentence[:-1])) if len(sentence) else np.zeros(0, np.int64)
    size = np.diff(np.append(first, len(sentence)))
    length = np.sqrt(np.add.reduceat(value * value, first)) if len(first) else np.zeros(0)
    gram = _gram(term, first, size, value / np.maximum(np.repeat(length, size), 1e-9), len(good))

    # Truncated singular value decomposition: subspace iteration on X'X.
    k = min(settings.dimensions, len(good))
    q = np.random.default_rng(1).standard_normal((len(good), min(k + 8, len(good)))).astype(np.float32)
    for _ in range(settings.iterations):
        q = np.linalg.qr(gram @ q)[0]
    _, turn = np.linalg.eigh(q.T @ gram @ q)
    space = (q @ turn)[:, ::-1][:, :k].astype(np.float32)

    embedded = np.zeros((len(s.of_sentence), k), np.float32)
    for a in range(0, len(first), 50_000):
        lo, hi = first[a], first[a + 50_000] if a + 50_000 < len(first) else len(sentence)
        embedded += _row_sums(space[term[lo:hi]] * value[lo:hi, None].astype(np.float32), sentence[lo:hi], len(embedded)) if hi > lo else 0
    norm = np.linalg.norm(embedded, axis=1)
    unit = embedded / np.maximum(norm, 1e-9)[:, None]
    of, lang = s.of_sentence, np.array(langs)
    keys = [(j, g) for j in range(n_subjects) for g in sorted({x for x in langs if x} or {""}) if ((marks[:, j] > 0) & (lang == g)).sum() >= settings.least_documents] or []
    keys += [(j, "") for j in range(n_subjects) if j not in {x for x, _ in keys}]
    allowed = np.stack([(marks[:, j] > 0) & ((lang == g) | (lang == "") | (g == "")) for j, g in keys], axis=1)[of]
    seeds = np.stack([(unit * (shares[of, j] * allowed[:, c])[:, None]).sum(0) for c, (j, _) in enumerate(keys)])
    centroids = seeds / np.maximum(np.linalg.norm(seeds, axis=1, keepdims=True), 1e-9)
    for _ in range(settings.rounds):
        near = np.where(allowed, unit @ centroids.T, -1)
        own, best = near.argmax(1), near.max(1)
        new = np.stack([unit[(own == c) & (best > settings.near)].sum(0) for c in range(len(keys))])
        size = np.linalg.norm(new, axis=1, keepdims=True)
        new = np.where(size > 0, new / np.maximum(size, 1e-9), centroids)
        moved, centroids = (new * centroids).sum(1).min(), new
        if moved > 0.9999:
            break
    near = unit @ centroids.T
    own = near.max(1)
    typical = np.median((own * norm)[own > settings.near]) if (own > settings.near).any() else 0.0
    pull = (space @ centroids.T) * weight[:, None]
    return Model(speller, pull.astype(np.float32), np.array([j for j, _ in keys]), float(settings.long_enough * typical))


def assign(texts: pa.Array, model: Model, n_subjects: int) -> np.ndarray:
    """Sentences of each text about each subject (texts x subjects)."""
    s = sentences(texts)
    out = np.zeros((len(texts), n_subjects), np.int64)
    if not len(s.term) or not len(model.speller.terms):
        return out
    term = model.speller(s.terms)[s.term]
    there = term >= 0
    pulls = _row_sums(model.pull[term[there]], s.sentence[there], len(s.of_sentence))
    best = pulls.argmax(1)  # the nearest by cosine too: a sentence's own length divides all alike
    about = pulls[np.arange(len(best)), best] >= max(model.least, 1e-9)
    np.add.at(out, (s.of_sentence[about], model.subject[best[about]]), 1)
    return out


def areas(documents: DataFrame, labels: DataFrame, subjects: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Rows (doc_id, subject, n_sentences, n_area_sentences): the areas of each document.

    An area counts when at least ``least_sentences`` sentences, and ``least_share`` of the document's sentences that deal with
    any area, are about it. NULL or blank texts, and texts about nothing known, give no row, as does a NULL doc_id. Labels
    may be dirty (see ``subject_codes``); labels of unknown documents or subjects count for nothing. Without usable labels and
    descriptions there is no model and no row. Texts are read whole; rows of one doc_id are decided each by itself.
    """
    settings = settings or Settings()
    codes, named = subject_codes(labels, subjects)
    about = {r[0]: " ".join(x for x in r[1:] if x) for r in bounded_rows(subjects.filter("subject is not null").select("subject", "title", "description"), 10_000, "subjects")}
    chosen = named.groupBy("doc_id").agg(F.collect_set("k").alias("ks")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.most_labelled)
    fields = ["text", F.lower(F.substring(F.trim("lang"), 1, 2)).alias("lang")] if "lang" in documents.columns else ["text", F.lit("").alias("lang")]
    sample = documents.filter(F.col("text").isNotNull() & (F.length("text") <= settings.most_chars)).select("doc_id", *fields).join(F.broadcast(chosen), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(settings.most_labelled).collect()
    marks = np.zeros((len(sample), len(codes)))
    for i, r in enumerate(sample):
        marks[i, r.ks] = 1
    model = fit([r.text for r in sample], [r.lang or "" for r in sample], marks, [about[c] for c in codes], lambda terms: document_frequencies(documents, terms), settings)
    n, (part, whole), least = len(codes), settings.least_share, settings.least_sentences
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("subject", T.StringType()), T.StructField("n_sentences", T.LongType()), T.StructField("n_area_sentences", T.LongType())])

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = assign(batch.column(1), model, n)
            every = counts.sum(1)
            text, subject = np.nonzero((counts >= least) & (counts * whole >= every[:, None] * part))
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(ids[text].astype(np.int64)), pa.array([codes[j] for j in subject], pa.string()), pa.array(counts[text, subject]), pa.array(every[text])], names=["doc_id", "subject", "n_sentences", "n_area_sentences"])

    return documents.filter("doc_id is not null and text is not null").select(F.col("doc_id").cast("bigint"), "text").mapInArrow(decide, schema)
