"""Language of texts and of spans inside them: scripts, then Viterbi over words.

A word (a run of letters) may only be in languages that use its script; among these it
scores the log-probability of its letter trigrams. Viterbi with a fixed penalty for a
change of language labels all words of a text, so a passage in another language becomes
a span of its own and single odd words do not. The language of most letters is the
text's; its share of the letters is the score.

The model holds hashed trigram counts per language, learned from a bounded sample of
labelled texts (``SAMPLE_PER_LANGUAGE`` of each of ``MOST_LANGUAGES`` languages, taken by a hash of the id).

Defined cases: a text that is null or has no letter is ``und`` with score 0, as is every
text if nothing could be learned. Words in a script no language uses say nothing and take
the language around them. Ties go to the alphabetically first language. Repeated rows
give repeated rows; columns other than id, text and label are not read.
"""

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from litsearch.llm.common import hash_limit, run_starts, strings, table
from litsearch.llm.op7_byte_bpe import groups

#: First code point, last code point and name of scripts.
SCRIPTS = (
    (0x0041, 0x024F, "latin"), (0x0250, 0x02FF, "latin"), (0x0370, 0x03FF, "greek"),
    (0x0400, 0x052F, "cyrillic"), (0x0530, 0x058F, "armenian"), (0x0590, 0x05FF, "hebrew"),
    (0x0600, 0x077F, "arabic"), (0x0900, 0x097F, "devanagari"), (0x0980, 0x09FF, "bengali"),
    (0x0A00, 0x0A7F, "gurmukhi"), (0x0A80, 0x0AFF, "gujarati"), (0x0B80, 0x0BFF, "tamil"),
    (0x0C00, 0x0C7F, "telugu"), (0x0C80, 0x0CFF, "kannada"), (0x0D00, 0x0D7F, "malayalam"),
    (0x0E00, 0x0E7F, "thai"), (0x0E80, 0x0EFF, "lao"), (0x1000, 0x109F, "myanmar"),
    (0x10A0, 0x10FF, "georgian"), (0x1100, 0x11FF, "hangul"), (0x1200, 0x137F, "ethiopic"),
    (0x1780, 0x17FF, "khmer"), (0x1E00, 0x1EFF, "latin"), (0x1F00, 0x1FFF, "greek"),
    (0x3040, 0x30FF, "kana"), (0x3400, 0x9FFF, "han"), (0xAC00, 0xD7AF, "hangul"),
    (0xF900, 0xFAFF, "han"), (0xFB50, 0xFDFF, "arabic"), (0xFE70, 0xFEFF, "arabic"),
    (0x20000, 0x323AF, "han"),
)
SCRIPT_NAMES = ("other", *sorted({name for _, _, name in SCRIPTS}))
FEATURES = 1 << 14
#: Labelled texts to learn from, of each language: the bound of the sample.
SAMPLE_PER_LANGUAGE = 2000
#: Languages learned at most, the most frequent ones.
MOST_LANGUAGES = 1000
#: A language uses a script if so much of its letters are in it.
SCRIPT_SHARE = 0.01
#: Log-probability a change of language costs, and a word in a script that is not used.
SWITCH, NOT_USED = 12.0, 1000.0
SMOOTHING = 0.5
BLOCK = 128
UNKNOWN = "und"


@lru_cache(maxsize=1)
def letters() -> tuple[np.ndarray, np.ndarray]:
    """By code point: the lower-case letter (0: no letter) and the number of its script."""
    chars = [chr(i) for i in range(0x110000)]
    lower = np.zeros(0x110000, np.uint32)
    for i, c in enumerate(chars):
        if c.isalpha():
            small = c.lower()
            lower[i] = ord(small) if len(small) == 1 else i
    script = np.zeros(0x110000, np.uint8)
    for first, last, name in SCRIPTS:
        script[first:last + 1] = SCRIPT_NAMES.index(name)
    return lower, script


@dataclass
class Words:
    """Words of several texts laid end to end, each text followed by a blank."""

    letter_feature: np.ndarray  # of each letter
    first_letter: np.ndarray  # of each word, among the letters
    begin: np.ndarray  # of each word, in code points from the start of its text
    end: np.ndarray
    script: np.ndarray
    text: np.ndarray  # number of the word's text


def cut_words(values: list[str]) -> Words:
    lower, script = letters()
    codes = np.frombuffer(" ".join([*values, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.concatenate(([0], np.cumsum([len(v) + 1 for v in values])))
    low = np.concatenate(([0], lower[codes], [0])).astype(np.uint64)
    mixed = low[:-2] * 0x9E3779B1 + low[1:-1] * 0x85EBCA6B + low[2:] * 0xC2B2AE35
    at = np.flatnonzero(low[1:-1])
    feature = ((mixed[at] * 0x9E3779B97F4A7C15) >> np.uint64(64 - 14)).astype(np.int32)
    first = np.flatnonzero(np.concatenate(([True], np.diff(at) != 1))) if len(at) else at
    begin = at[first]
    end = at[np.append(first[1:], len(at)) - 1] + 1 if len(at) else at
    text = np.searchsorted(starts, begin, "right") - 1
    return Words(feature, first, begin - starts[text], end - starts[text], script[codes[begin]], text)


@dataclass
class Model:
    languages: list[str]
    log_share: np.ndarray  # features x languages
    uses: np.ndarray  # scripts x languages, of booleans


def held_out(id_col: str, parts: int, part: int) -> Column:
    """Is the crc32 of the id's text, mod ``parts``, equal to ``part``?"""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % parts == part, F.lit(False))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          sample: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Count the trigrams of a bounded sample of labelled texts; counts are summed by Spark."""
    labelled = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"),
                           F.col(text_col).alias("text")).filter("lang IS NOT NULL")
    sizes = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
             .orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((FEATURES, 0), np.float32), np.zeros((len(SCRIPT_NAMES), 0), bool))
    upto = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, hash_limit(sample, n))])
    drawn = labelled.filter(F.xxhash64(F.lit("sample"), "id") <= upto[F.col("lang")]).select("lang", "text")

    def count(batches):
        for batch in batches:
            names = np.array(batch.column("lang").to_pylist(), object)
            values = np.array(strings(batch.column("text")), object)
            for lang in sorted(set(names)):
                for group in groups(list(values[names == lang])):
                    words = cut_words(group)
                    length = np.diff(np.append(words.first_letter, len(words.letter_feature)))
                    counts = np.concatenate((
                        np.bincount(words.letter_feature, minlength=FEATURES),
                        np.bincount(words.script, length, minlength=len(SCRIPT_NAMES)).astype(np.int64)))
                    found = np.flatnonzero(counts)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(found), pa.string()), pa.array(found, pa.int32()),
                         pa.array(counts[found], pa.int64())], names=["lang", "feature", "n"])

    # at most (features + scripts) rows of each language
    counted = (drawn.mapInArrow(count, "lang string, feature int, n long")
               .groupBy("lang", "feature").agg(F.sum("n").alias("n")).toPandas())
    counts = np.zeros((FEATURES + len(SCRIPT_NAMES), len(languages)))
    counts[counted["feature"], [languages.index(x) for x in counted["lang"]]] = counted["n"]
    grams, scripts = counts[:FEATURES], counts[FEATURES:]
    log_share = np.log((grams + SMOOTHING) / (grams + SMOOTHING).sum(0))
    uses = scripts >= np.maximum(1, scripts.sum(0) * SCRIPT_SHARE)
    return Model(languages, log_share.astype(np.float32), uses)


def word_scores(words: Words, model: Model) -> np.ndarray:
    """Words x languages."""
    if not len(words.begin):
        return np.zeros((0, len(model.languages)), np.float32)
    scores = np.add.reduceat(model.log_share[words.letter_feature], words.first_letter, axis=0)
    uses = model.uses[words.script]
    known = uses.any(axis=1, keepdims=True)
    return np.where(known, scores - NOT_USED * ~uses, 0).astype(np.float64)


def viterbi(scores: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """The best label of each row, where a change before row i costs ``cost[i]``.

    All blocks of ``BLOCK`` rows are walked side by side, once from every label they may
    begin with; then the blocks are chained, and walked back likewise.
    """
    n, labels = scores.shape
    blocks = -(-n // BLOCK)
    s = np.zeros((blocks * BLOCK, labels))
    s[:n] = scores
    c = np.zeros(blocks * BLOCK)
    c[:n] = cost
    s, c = s.reshape(blocks, BLOCK, labels), c.reshape(blocks, BLOCK)
    through = np.where(np.eye(labels, dtype=bool), 0.0, -np.inf) + np.zeros((blocks, 1, 1))
    for j in range(BLOCK):
        best = through.max(axis=2, keepdims=True) - c[:, j, None, None]
        through = np.maximum(through, best) + s[:, j, None, :]
    value = np.zeros((blocks, labels))
    for b in range(1, blocks):
        now = (value[b - 1][:, None] + through[b - 1]).max(axis=0)
        value[b] = now - now.max()
    came = np.zeros((BLOCK, blocks, labels), np.int16)
    own = np.arange(labels, dtype=np.int16)
    for j in range(BLOCK):
        best = value.max(axis=1) - c[:, j]
        came[j] = np.where(value >= best[:, None], own, value.argmax(axis=1)[:, None])
        value = np.maximum(value, best[:, None]) + s[:, j]
    back = np.tile(own, (blocks, 1))
    for j in range(BLOCK - 1, -1, -1):
        back = np.take_along_axis(came[j], back, axis=1)
    last = np.zeros(blocks, np.int64)
    last[-1] = value[-1].argmax()
    for b in range(blocks - 1, 0, -1):
        last[b - 1] = back[b, last[b]]
    out = np.zeros((blocks, BLOCK), np.int64)
    state = last
    every = np.arange(blocks)
    for j in range(BLOCK - 1, -1, -1):
        out[:, j] = state
        state = came[j][every, state]
    return out.reshape(-1)[:n]


def label_texts(values: list[str], model: Model):
    """Language and score of each text, and its spans (text number, begin, end, language number)."""
    n, k = len(values), len(model.languages)
    words = cut_words(values)
    if not len(words.begin) or not k:
        return [UNKNOWN] * n, np.zeros(n), (np.zeros(0, np.int64),) * 4
    new_text = np.concatenate(([True], words.text[1:] != words.text[:-1]))
    label = viterbi(word_scores(words, model), np.where(new_text, 0.0, SWITCH))
    length = words.end - words.begin
    share = np.bincount(words.text * k + label, length, minlength=n * k).reshape(n, k)
    total = share.sum(axis=1)
    top = share.argmax(axis=1)
    score = share[np.arange(n), top] / np.maximum(total, 1)
    languages = [model.languages[i] if t else UNKNOWN for i, t in zip(top, total)]
    first = run_starts(words.text * k + label)
    last = np.append(first[1:], len(label)) - 1
    return languages, score, (words.text[first], words.begin[first], words.end[last], label[first])


SPANS = "array<struct<begin:long,end:long,lang:string>>"


def identify(docs: DataFrame, model: Model, text_col: str = "text", spans: bool = True) -> DataFrame:
    """All columns of ``docs`` and ``lang_pred``, ``lang_score`` and (if asked) ``lang_spans``."""
    added = ["lang_pred", "lang_score", *["lang_spans"] * spans]
    kept = [f for f in docs.schema.fields if f.name not in added]
    kinds = [T.StringType(), T.DoubleType(), T._parse_datatype_string(SPANS)]
    schema = T.StructType(kept + [T.StructField(n, k) for n, k in zip(added, kinds)])
    chars = max(50_000, 4_000_000 // max(4, len(model.languages)))

    def run(batches):
        for batch in batches:
            languages, scores, counts, rows = [], [], [], []
            for group in groups(strings(batch.column(text_col)), chars):
                lang, score, span = label_texts(group, model)
                languages += lang
                scores.append(score)
                counts.append(np.bincount(span[0], minlength=len(group)))
                rows.append(span[1:])
            begin, end, label = (np.concatenate(x) if x else np.zeros(0, np.int64)
                                 for x in (zip(*rows) if rows else ((), (), ())))
            columns = [batch.column(f.name) for f in kept]
            columns += [pa.array(languages, pa.string()), pa.array(np.concatenate([*scores, []]))]
            if spans:
                names = pa.array(model.languages, pa.string()).take(pa.array(label.astype(np.int64)))
                offsets = np.concatenate(([0], np.cumsum(np.concatenate([*counts, []])))).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(
                    pa.array(offsets), pa.StructArray.from_arrays(
                        [pa.array(begin, pa.int64()), pa.array(end, pa.int64()), names],
                        names=["begin", "end", "lang"])))
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema.fields])

    return docs.select(*[F.col(f"`{f.name}`") for f in kept]).mapInArrow(run, schema)


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = learn(docs.filter(~held_out("doc_id", 4, 2)))
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred",
        F.col("lang_score").alias("score"), F.size("lang_spans").cast("long").alias("n_spans"))
