"""Language identification: script ranges, per-word scores and a Viterbi path with a switching
penalty.

The model has, for each learned language, log probabilities of hashed character n-grams and the
scripts that its training text uses. A word's script narrows the languages that it may be of; its
n-grams score them. The best path over the words of a text, where changing the language costs a
penalty, cuts the text into spans of one language each.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfgap.llm.common import free_name, remainder

UNKNOWN = "und"
BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS  # of hashed n-grams
ORDERS = (1, 2, 3)
SMOOTHING = 0.1
DOCS_PER_LANGUAGE = 5_000  # bound of the training sample
SWITCH_PENALTY = 20.0
WORD_BOUND = 8.0  # no word speaks louder for or against a language
FOREIGN_SCRIPT = -30.0
SCRIPT_SHARE = 0.02  # of a language's letters, for it to be a candidate of a script
WORDS_AT_ONCE = 200_000
CACHE_BYTES = 48 << 20

# First code points of script ranges; letters outside are of script 0.
SCRIPT_RANGES = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"),
    (0x0590, "hebrew"), (0x0600, "arabic"), (0x0780, "other"), (0x0900, "devanagari"),
    (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "oriya"),
    (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"),
    (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"),
    (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"),
    (0x1400, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
    (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"), (0xA000, "other"),
    (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"),
]
_STARTS = [start for start, _ in SCRIPT_RANGES]
SCRIPTS = sorted({name for _, name in SCRIPT_RANGES})
_SCRIPT_OF_RANGE = [SCRIPTS.index(name) for _, name in SCRIPT_RANGES]
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_BEGIN, _END, _BETWEEN = ord("<"), ord(">"), ord("\n")
_letters = np.zeros(0, bool)


def _is_letter() -> np.ndarray:
    """A flag for every code point."""
    global _letters
    if not len(_letters):
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


@dataclass(frozen=True)
class WordGrams:
    """Letters and script of every word, and the n-grams of those with letters: their rows
    (``lettered``), buckets in turn, and where each row's begin."""

    letters: np.ndarray
    scripts: np.ndarray
    lettered: np.ndarray
    buckets: np.ndarray
    starts: np.ndarray


def grams_of(words: list[bytes]) -> WordGrams:
    """Looks at the letters of the words in lower case, with marked ends, all words together."""
    joined = b"\n".join(words).decode("utf-8", "replace").lower()
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    word = np.cumsum(codes == _BETWEEN)
    kept = _is_letter()[codes]
    codes, word = codes[kept], word[kept]
    letters = np.bincount(word, minlength=len(words))
    lettered = np.flatnonzero(letters)
    row = np.searchsorted(lettered, word)
    n = letters[lettered]
    first = np.cumsum(n + 2) - (n + 2)  # of a row's marked letters
    text = np.full(int((n + 2).sum()), _END, np.uint64)
    text[first] = _BEGIN
    text[np.arange(len(codes)) + 1 + 2 * row] = codes
    of = np.repeat(np.arange(len(n)), n + 2)
    left = np.repeat(first + n + 2, n + 2) - np.arange(len(text))  # symbols from here to the end
    buckets, owners = [], []
    for order in ORDERS:
        hashed = np.full(len(text), order, np.uint64)
        for k in range(order):
            hashed[: len(text) - k] += text[k:] * _FACTORS[k]
        hashed = (hashed ^ hashed >> np.uint64(29)) * _FACTORS[0]
        fits = left >= order
        buckets.append((hashed >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)[fits])
        owners.append(of[fits])
    order = np.argsort(np.concatenate(owners), kind="stable")
    counts = np.bincount(np.concatenate(owners), minlength=len(n))
    # The script that most letters have, the first of several; of most words it is clear at once.
    scripts = np.full(len(words), _SCRIPT_OF_RANGE[0])
    other = np.unique(word[codes >= _STARTS[1]])
    if len(other):
        mine = np.isin(word, other)
        script = np.array(_SCRIPT_OF_RANGE)[np.searchsorted(_STARTS, codes[mine], "right") - 1]
        cell = np.searchsorted(other, word[mine]) * len(SCRIPTS) + script
        table = np.bincount(cell, minlength=len(other) * len(SCRIPTS)).reshape(-1, len(SCRIPTS))
        scripts[other] = table.argmax(1)
    return WordGrams(letters, scripts, lettered, np.concatenate(buckets)[order], np.cumsum(counts) - counts)


@dataclass(frozen=True)
class LanguageModel:
    """Languages in order, log probabilities (languages x buckets) and candidates (scripts x
    languages)."""

    languages: list[str]
    log_prob: np.ndarray
    candidates: np.ndarray


def training_rows(docs: DataFrame, docs_per_language: int, text: str = "text") -> DataFrame:
    """lang and text of rows with a language whose crc32(doc_id) modulo 5 is not 0; of languages
    with more than ``docs_per_language`` such rows about that many, chosen by a hash of doc_id.
    """
    rows = docs.select("doc_id", "lang", F.col(text).alias("text"))
    rows = rows.where(F.col("lang").isNotNull() & (F.coalesce(remainder(F.col("doc_id")), F.lit(0)) != 0))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return rows.select("lang", "text").limit(0)
    share = F.create_map(
        *[F.lit(x) for lang, n in counts.items() for x in (lang, docs_per_language / n)]
    )
    hashed = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    return rows.where(hashed < F.try_element_at(share, F.col("lang"))).select("lang", "text")


def _texts(column: pa.Array) -> Iterator[list[bytes]]:
    for value in column:
        yield (value.as_py() or b"").split()


def fit(
    docs: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE, text: str = "text"
) -> LanguageModel:
    """Learns from the training rows of ``docs``; without any the model has no language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: dict[str, np.ndarray] = {}
        for batch in batches:
            words: dict[str, Counter] = {}
            for lang, split in zip(batch.column(0).to_pylist(), _texts(batch.column(1))):
                words.setdefault(lang, Counter()).update(split)
            for lang, counts in words.items():
                tally = grams.setdefault(lang, np.zeros(BUCKETS + len(SCRIPTS), np.int64))
                found = grams_of(list(counts))
                times = np.fromiter(counts.values(), np.int64, len(counts))
                sizes = np.diff(np.append(found.starts, len(found.buckets)))
                weights = np.repeat(times[found.lettered], sizes)
                tally[:BUCKETS] += np.bincount(found.buckets, weights, BUCKETS).astype(np.int64)
                letters = np.bincount(found.scripts, times * found.letters, len(SCRIPTS))
                tally[BUCKETS:] += letters.astype(np.int64)
        for lang, tally in grams.items():
            at = np.flatnonzero(tally)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(tally[at])],
                ["lang", "bucket", "n"],
            )

    rows = training_rows(docs, docs_per_language, text)
    rows = rows.select("lang", F.col("text").cast("binary").alias("text"))
    counts = rows.mapInArrow(count, "lang string, bucket long, n long")
    # Languages x buckets rows, whatever the size of the input.
    table = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    langs = np.array(table["lang"].to_pylist(), object)
    languages = sorted(set(langs))
    tally = np.zeros((len(languages), BUCKETS + len(SCRIPTS)))
    if languages:
        tally[np.searchsorted(np.array(languages, object), langs), table["bucket"].to_numpy()] = table["n"].to_numpy()
    grams, scripts = tally[:, :BUCKETS] + SMOOTHING, tally[:, BUCKETS:]
    log_prob = np.log(grams / grams.sum(1, keepdims=True)) if languages else grams
    share = scripts / np.maximum(scripts.sum(1, keepdims=True), 1)
    candidates = (share >= SCRIPT_SHARE).T
    candidates[~candidates.any(1)] = True  # a script that no training text uses decides nothing
    return LanguageModel(languages, log_prob.astype(np.float32), candidates)


class WordScores:
    """Scores (words x languages) and letters of the words seen so far, within CACHE_BYTES."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.log_prob = np.ascontiguousarray(model.log_prob.T)
        self.most = CACHE_BYTES // (4 * len(model.languages) + 8)
        self.clear()

    def clear(self) -> None:
        self.row: dict[bytes, int] = {}
        self.scores = np.zeros((0, len(self.model.languages)), np.float32)
        self.letters = np.zeros(0, np.int64)

    def _score(self, found: WordGrams) -> np.ndarray:
        scores = np.zeros((len(found.letters), len(self.model.languages)), np.float32)
        if len(found.lettered) and scores.shape[1]:
            logs = np.add.reduceat(self.log_prob[found.buckets], found.starts, axis=0) / len(ORDERS)
            mask = self.model.candidates[found.scripts[found.lettered]]
            best = np.where(mask, logs, -np.inf).max(1, keepdims=True)
            scores[found.lettered] = np.where(mask, np.maximum(logs - best, -WORD_BOUND), FOREIGN_SCRIPT)
        return scores

    def rows(self, words: list[bytes]) -> np.ndarray:
        """Row numbers of the words; new ones are scored together."""
        if len(self.row) > self.most:
            self.clear()
        new = sorted(set(words).difference(self.row))
        if new:
            self.row.update(zip(new, range(len(self.row), len(self.row) + len(new))))
            found = grams_of(new)
            self.scores = np.concatenate([self.scores, self._score(found)])
            self.letters = np.concatenate([self.letters, found.letters])
        return np.fromiter(map(self.row.__getitem__, words), np.int64, len(words))


def one_language_is_best(scores: np.ndarray, language: int, penalty: float) -> bool:
    """Whether no path that changes the language beats staying with ``language``, the best one for
    the whole text: no run of words gains more than one change costs."""
    others = np.delete(scores, language, 1)
    if not others.shape[1]:
        return True
    gain = np.cumsum(others.max(1) - scores[:, language], dtype=np.float64)
    low = np.minimum(np.minimum.accumulate(np.concatenate([[0.0], gain[:-1]])), 0.0)
    return bool((gain - low).max() <= penalty)


def viterbi(texts: list[np.ndarray], penalty: float) -> list[np.ndarray]:
    """The best language of every word, for all texts (words x languages) side by side: step t
    takes the t-th word of all texts that have one."""
    order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
    lengths = np.array([len(texts[k]) for k in order])
    if not len(order) or not lengths[0]:
        return [np.zeros(0, np.int64) for _ in texts]
    n_languages = texts[0].shape[1]
    value = np.zeros((len(order), n_languages))
    came: list[np.ndarray] = []
    for t in range(lengths[0]):
        active = int(np.searchsorted(-lengths, -t, side="left"))
        now = value[:active]
        if t:
            best = now.argmax(1)
            top = now[np.arange(active), best][:, None] - penalty
            came.append(np.where(now >= top, np.arange(n_languages), best[:, None]))
            np.maximum(now, top, out=now)
        now += np.stack([texts[order[k]][t] for k in range(active)])
    paths = [np.zeros(n, np.int64) for n in lengths]
    for k, path in enumerate(paths):
        state = int(value[k].argmax())
        for t in range(len(path) - 1, -1, -1):
            path[t] = state
            if t:
                state = int(came[t - 1][k][state])
    out: list[np.ndarray] = [paths[0]] * len(texts)
    for place, k in enumerate(order):
        out[k] = paths[place]
    return out


def label_texts(
    texts: list[list[bytes]], words: WordScores, penalty: float
) -> list[tuple[str, float, list[tuple[int, int, str]]]]:
    """Language, score and spans (first word, end word, language) of every text."""
    languages = words.model.languages
    rows = words.rows([word for text in texts for word in text])
    ends = np.cumsum([len(text) for text in texts])
    scores = np.split(words.scores[rows], ends[:-1]) if texts else []
    letters = np.split(words.letters[rows], ends[:-1]) if texts else []
    totals = [s.sum(0, dtype=np.float64) for s in scores]
    best = [int(t.argmax()) if len(t) else 0 for t in totals]
    mixed = [
        k
        for k, s in enumerate(scores)
        if len(s) and languages and not one_language_is_best(s, best[k], penalty)
    ]
    paths = dict(zip(mixed, viterbi([scores[k] for k in mixed], penalty)))
    out = []
    for k, text in enumerate(texts):
        n = int(letters[k].sum())
        if not n or not languages:
            out.append((UNKNOWN, 0.0, []))
            continue
        if k not in paths:
            winner, share, spans = best[k], 1.0, [(0, len(text), languages[best[k]])]
        else:
            path = paths[k]
            per = np.bincount(path, letters[k], len(languages))
            winner, share = int(per.argmax()), float(per.max() / n)
            cuts = np.flatnonzero(np.diff(path)) + 1
            edges = [0, *cuts.tolist(), len(text)]
            spans = [(a, b, languages[path[a]]) for a, b in zip(edges, edges[1:])]
        rivals = np.delete(totals[k], winner)
        margin = totals[k][winner] - rivals.max() if len(rivals) else np.inf
        certain = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
        out.append((languages[winner], share * float(certain if share == 1 else 1), spans))
    return out


SPANS = T.ArrayType(
    T.StructType([T.StructField("first", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("lang", T.StringType())])
)


def identify(
    docs: DataFrame,
    model: LanguageModel,
    penalty: float = SWITCH_PENALTY,
    text: str = "text",
    with_spans: bool = False,
    names: tuple[str, str, str] = ("lang_pred", "score", "lang_spans"),
) -> DataFrame:
    """The columns of ``docs`` with lang_pred and score, and ``lang_spans`` if asked for, or by
    whatever names are given.

    The language is the one whose spans have most letters, the score their share; for a text of
    one language the probability of it against the next best. A text without letters, NULL
    included, is ``und`` with score 0, and so is every text if nothing has been learned. Ties go
    to the language that sorts first. Equal texts get equal results, whole texts are read whatever
    their length, and columns named like the new ones are replaced. Only ``text`` is looked at.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # languages x buckets, of fixed size
    fields = [pa.field(names[0], pa.string()), pa.field(names[1], pa.float64())]
    if with_spans:
        span = pa.struct([("first", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])
        fields.append(pa.field(names[2], pa.list_(span)))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordScores(sent.value)
        for batch in batches:
            found: list = []
            waiting: list[list[bytes]] = []
            n = 0
            for split in _texts(batch.column(0)):
                waiting.append(split)
                n += len(split)
                if n >= WORDS_AT_ONCE:
                    found += label_texts(waiting, words, penalty)
                    waiting, n = [], 0
            found += label_texts(waiting, words, penalty)
            columns = [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
            if with_spans:
                rows = [[{"first": a, "end": b, "lang": c} for a, b, c in x[2]] for x in found]
                columns.append(pa.array(rows, fields[2].type))
            old = range(1, batch.num_columns)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in old], *columns],
                schema=pa.schema([*[batch.schema.field(k) for k in old], *fields]),
            )

    kept = [c for c in docs.columns if c not in {f.name for f in fields}]
    schema = docs.select(*kept).schema.add(names[0], "string").add(names[1], "double")
    if with_spans:
        schema = schema.add(names[2], SPANS)
    source = docs.select(F.col(text).cast("binary").alias("_text_bytes"), *kept)
    return source.mapInArrow(label, schema)


def predict_documents(docs: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row; the model never sees held-out rows."""
    rows = docs.select("doc_id", "text")
    held_out = F.coalesce(remainder(F.col("doc_id")) == 0, F.lit(False))
    rows = rows.select("doc_id", held_out.alias("held_out"), "text")
    found = identify(rows.select("doc_id", "held_out", "text"), fit(docs, docs_per_language))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def keep_known(docs: DataFrame, least: float = 0.5, docs_per_language: int = DOCS_PER_LANGUAGE) -> DataFrame:
    """The rows of ``docs`` whose text is of one learned language: not ``und``, and with a score of
    ``least`` or more. If nothing can be learned, because no row has a language, all texts with a
    letter stay."""
    model = fit(docs, docs_per_language)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    lang, score = free_name(docs, "lang_pred"), free_name(docs, "lang_score")
    found = identify(docs, model, names=(lang, score, free_name(docs, "lang_spans")))
    return found.where((F.col(lang) != UNKNOWN) & (F.col(score) >= least)).select(*docs.columns)
