"""Operator 7: language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text recognises all substrings of it. A text is parsed
greedily into phrases, each the longest match in the automaton (or one unknown letter), over word borders; the
fewer phrases, normalised by text length and by the automaton's text size, the closer the language.

Texts count in lower case, each run of other characters than letters as one space. They are parsed in stretches
of `STRETCH` characters, at whose ends a phrase ends, so that the stretches of many texts are parsed side by side: one numpy
operation takes all of them a character further.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from . import common as C

OTHERS = re.compile(r"[\W\d_]+")
STRETCH = 2048
#: Letters are told apart by 64 classes: 0 is the space, the most frequent letters have one each, others share the last ones by code point.
CLASSES, OWN = 64, 48


def normalize(text: str | None) -> str:
    """Lower case, letters only, with one space before, between and after words."""
    found = OTHERS.sub(" ", (text or "").lower()).strip()
    return f" {found} " if found else ""


class SuffixAutomaton:
    """A text's suffix automaton as tables: of a state with one way on its class and target, of the others a row of `rows`."""

    def __init__(self, text: list[int]):
        step, link, length, last = [{}], [-1], [0], 0
        for c in text:
            now = len(step)
            step.append({})
            link.append(0)
            length.append(length[last] + 1)
            p = last
            while p >= 0 and c not in step[p]:
                step[p][c] = now
                p = link[p]
            if p >= 0:
                q = step[p][c]
                if length[p] + 1 == length[q]:
                    link[now] = q
                else:
                    clone = len(step)
                    step.append(dict(step[q]))
                    link.append(link[q])
                    length.append(length[p] + 1)
                    while p >= 0 and step[p].get(c) == q:
                        step[p][c] = clone
                        p = link[p]
                    link[q] = link[now] = clone
            last = now
        self.size = len(text)
        # Row 0 leads nowhere, row 1 is the start's.
        many = [0] + [s for s, d in enumerate(step) if s and len(d) > 1]
        self.rows = np.full((len(many) + 1, CLASSES), -1, np.int32)
        self.only, self.target, self.row = np.full(len(step), -1, np.int32), np.full(len(step), -1, np.int32), np.zeros(len(step), np.int32)
        for r, s in enumerate(many, 1):
            self.row[s] = r
            for c, t in step[s].items():
                self.rows[r, c] = t
        for s, d in enumerate(step):
            if s and len(d) == 1:
                ((self.only[s], self.target[s]),) = d.items()

    def phrases(self, flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Longest-match phrases of stretches of `flat` (classes), in order of falling length."""
        n = len(start)
        state, count, table = np.zeros(n, np.int32), np.zeros(n, np.int32), self.rows.ravel()
        active = np.searchsorted(-length, -np.arange(int(length.max(initial=0))), "left").tolist()
        for t, n in enumerate(active):
            c = flat.take(start[:n] + t)
            s = state[:n]
            after = table.take(self.row.take(s) * CLASSES + c)
            np.copyto(after, self.target.take(s), where=self.only.take(s) == c)
            miss = after < 0
            count[:n] += miss & (s > 0)
            np.copyto(after, self.rows[1].take(c), where=miss)
            unknown = after < 0
            count[:n] += unknown
            after[unknown] = 0
            state[:n] = after
        return count + (state > 0)


@dataclass(frozen=True)
class Models:
    """Classes of code points, and an automaton for each language."""

    classes: np.ndarray
    automata: dict[str, SuffixAutomaton]

    def coded(self, text: str) -> np.ndarray:
        return self.classes.take(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32))


def letter_classes(texts: Iterable[str]) -> np.ndarray:
    """The class of each code point, by the letters of all training texts."""
    counts = Counter()
    for text in texts:
        counts.update(text)
    del counts[" "]
    out = (np.arange(0x110000) % (CLASSES - OWN - 1) + OWN + 1).astype(np.int32)
    for k, (c, _) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:OWN]):
        out[ord(c)] = k + 1
    out[ord(" ")] = 0
    return out


def labelled(documents: DataFrame, rows: int, chars: int) -> DataFrame:
    """lang, text, h and doc_id of labelled documents, whole, by hash order: at most `rows` a language, and no more after `chars` characters."""
    docs = C.documents(documents, F.col("lang").cast("string").alias("lang")).where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    order = F.xxhash64(F.col("doc_id").cast("string"))
    sizes = docs.groupBy("lang").agg(F.count("*").alias("n")).collect()  # a row for each language, as the automata are
    if not sizes:
        return docs.select("lang", "text", order.alias("h"), "doc_id")
    reach = F.create_map(*(F.lit(x) for r in sizes for x in (r["lang"], int(min(1.0, 4.0 * rows / r["n"]) * (1 << 20)))))
    likely = docs.where(F.pmod(order, F.lit(1 << 20)) <= F.element_at(reach, F.col("lang")))
    by_hash = Window.partitionBy("lang").orderBy("h", "doc_id", "size")
    first = likely.select("lang", "text", order.alias("h"), "doc_id", F.length("text").alias("size")).withColumn("k", F.row_number().over(by_hash)).where(F.col("k") <= rows)
    before = F.sum("size").over(Window.partitionBy("lang").orderBy("k")) - F.col("size")
    return first.withColumn("before", before).where(F.col("before") < chars).select("lang", "text", "h", "doc_id")


def train(documents: DataFrame, rows: int = 300, chars: int = 60_000) -> Models:
    """An automaton for each lang of the labelled documents, over the normalised texts of a bounded sample, one after another.

    The sample is bounded (see `labelled`), whatever the number of languages; its texts are whole. An automaton takes
    some 10 MB at the default.
    """
    texts: dict[str, list[str]] = {}
    for row in labelled(documents, rows, chars).orderBy("lang", "h", "doc_id", "text").toLocalIterator():
        texts.setdefault(row["lang"], []).append(normalize(row["text"]))
    joined = {lang: "".join(own).replace("  ", " ") for lang, own in sorted(texts.items())}
    models = Models(letter_classes(joined.values()), {})
    for lang, text in joined.items():
        models.automata[lang] = SuffixAutomaton(models.coded(text).tolist())
    return models


def predict(documents: DataFrame, models: Models) -> DataFrame:
    """doc_id, lang_pred and score of each document's whole text.

    score is b / (a + b) with the least and the second least entropies a and b (1 if there is one
    language). Very long texts are parsed whole, in many stretches. Defined cases: a null text or one without a letter is
    `und` with score 0, as is every text if no language was learned; ties go to the alphabetically first language; rows that
    repeat a doc_id each give a row; rows without doc_id are left out; other columns are ignored; an empty
    table gives an empty result.
    """
    docs = C.documents(documents)
    sent = docs.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        names = sorted(own.automata)
        weight = np.array([math.log2(own.automata[x].size + 1) for x in names])
        for batch in C.slices(batches, limit=4 << 20):
            texts = [normalize(x.as_py()) for x in batch.column("text")]
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            flat = own.coded("".join(texts))
            first, parts = np.cumsum(sizes) - sizes, -(-sizes // STRETCH)
            doc = np.repeat(np.arange(len(texts)), parts)
            begin = (np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)) * STRETCH
            length = np.minimum(STRETCH, sizes[doc] - begin)
            order = np.argsort(-length, kind="stable")
            start, length, doc = (first[doc] + begin)[order], length[order], doc[order]
            sums = np.stack([np.bincount(doc, own.automata[x].phrases(flat, start, length), len(texts)) for x in names], 1) if names else np.zeros((len(texts), 0))
            langs, scores = [], []
            for n, mine in zip(sizes.tolist(), sums * weight):
                if not n or not names:
                    langs.append("und")
                    scores.append(0.0)
                    continue
                entropy = mine / n
                best = int(np.argmin(entropy))
                rest = np.delete(entropy, best)
                langs.append(names[best])
                scores.append(float(rest.min() / (entropy[best] + rest.min())) if len(rest) else 1.0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.mapInArrow(run, "doc_id long, lang_pred string, score double")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    return predict(docs, train(docs.where(~held_out))).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
