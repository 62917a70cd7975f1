"""Language identification by unigram pieces, summed over all segmentations of a text."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stored
from .shared import renamed
from .words import hashes, mix, powers, slices, small_batches, text_of

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Longer runs of letters are scored in stretches of so many bytes.
LONGEST = 48
#: Words are runs of ASCII letters and characters beyond ASCII.
LETTERS = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def pieces(path: str) -> list[bytes]:
    """The vocabulary's pieces as bytes, a word's beginning as a blank, and all single bytes.

    Pieces that differ only by case are one, since texts are lower-cased; pieces that no word can
    contain are left out. Single bytes let every word be segmented.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = {bytes([b]) for b in range(256)}
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i):
            continue
        piece = model.id_to_piece(i).replace("▁", " ").lower().encode()
        body = piece[1:] if piece.startswith(b" ") else piece
        if body and body == body.translate(LETTERS) and b" " not in body and len(piece) <= LONGEST:
            found.add(piece)
    return sorted(found)


class Lattice:
    """Where pieces stand in words, by a hash table of the vocabulary."""

    def __init__(self, vocabulary: list[bytes]):
        joined = np.frombuffer(b"".join(vocabulary), np.uint8)
        length = np.array([len(p) for p in vocabulary])
        end = np.cumsum(length)
        key = hashes(joined, end - length, end)
        bits = int(np.ceil(np.log2(len(vocabulary) * 8)))
        self.down = np.uint64(64 - bits)
        order = np.argsort(key)
        self.key, self.id = key[order], order.astype(np.int32)
        slot = (self.key >> self.down).astype(np.int64)
        # keys are sorted, so those of one slot stand together
        self.first = np.searchsorted(slot, np.arange((1 << bits) + 1)).astype(np.int32)
        self.deepest = int(np.diff(self.first).max())
        self.longest = int(length.max())
        self.by_length = np.bincount(length, minlength=self.longest + 1) > 0

    def find(self, key: np.ndarray) -> np.ndarray:
        """Piece numbers of hashes, -1 where there is none."""
        slot = (key >> self.down).astype(np.int64)
        at, stop = self.first[slot], self.first[slot + 1]
        out = np.full(len(key), -1, np.int32)
        live = np.flatnonzero(at < stop)
        for _ in range(self.deepest):
            if not len(live):
                break
            same = self.key[at[live]] == key[live]
            out[live[same]] = self.id[at[live][same]]
            at[live] += 1
            live = live[~same]
            live = live[at[live] < stop[live]]
        return out

    def arcs(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> dict:
        """By end place and length: (words, piece numbers); words are in order of falling length."""
        size = end - start
        up, down = powers(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
        found = {}
        for i in range(1, int(size.max(initial=0)) + 1):
            live = int(np.searchsorted(-size, -i, "right"))
            s = start[:live]
            for n in range(1, min(i, self.longest) + 1):
                if not self.by_length[n]:
                    continue
                key = mix((sums[s + i] - sums[s + i - n]) * down[s + i - n] + np.uint64(n))
                piece = self.find(key)
                have = np.flatnonzero(piece >= 0)
                if len(have):
                    found[i, n] = have, piece[have]
        return found


def forward(arcs: dict, n_words: int, longest: int, prob: np.ndarray) -> np.ndarray:
    """Sums over all segmentations up to each place: (places, words, languages)."""
    alpha = np.zeros((longest + 1, n_words, prob.shape[1]))
    alpha[0] = 1
    for (i, n), (word, piece) in arcs.items():
        alpha[i, word] += alpha[i - n, word] * prob[piece]
    return alpha


def expected(arcs: dict, size: np.ndarray, count: np.ndarray, prob: np.ndarray) -> np.ndarray:
    """Expected uses of each piece over all segmentations, for one language's words."""
    longest, n = int(size.max(initial=0)), len(size)
    alpha = forward(arcs, n, longest, prob)[:, :, 0]
    beta = np.zeros((longest + 1, n))
    beta[size, np.arange(n)] = 1
    for (i, k), (word, piece) in sorted(arcs.items(), reverse=True):
        beta[i - k, word] += beta[i, word] * prob[piece, 0]
    weight = count / np.maximum(beta[0], 1e-300)
    out = np.zeros(len(prob))
    for (i, k), (word, piece) in arcs.items():
        np.add.at(out, piece, alpha[i - k, word] * prob[piece, 0] * beta[i, word] * weight[word])
    return out


def marked(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Groups of documents as bytes with a blank before each word: first, last + 1, bytes, word
    begins, word ends, each document's first word. Long words are cut into stretches."""
    for i, j, raw, offsets in slices(column):
        texts = [raw[a:b].decode("utf-8", "replace").lower().encode().translate(LETTERS)
                 for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        sizes = np.array([len(t) + 1 for t in texts])
        data = np.frombuffer(b" ".join([b"", *texts, b""]), np.uint8)
        blank = np.flatnonzero(data == 32)
        start, end = blank[:-1], blank[1:]
        real = end - start > 1
        start, end = start[real], end[real]
        long = end - start > LONGEST
        if long.any():
            parts = np.where(long, -(-(end - start) // LONGEST), 1)
            nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            start, end = np.repeat(start, parts) + nth * LONGEST, np.repeat(end, parts)
            end = np.minimum(end, np.where(np.repeat(long, parts), start + LONGEST, end))
        yield i, j, data, start, end, np.searchsorted(start, np.concatenate([[0], np.cumsum(sizes)]))


def _distinct(data: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Distinct words in order of falling length: begins, ends, and each word's place among them."""
    key = hashes(data, start, end)
    _, one, back = np.unique(key, return_index=True, return_inverse=True)
    order = np.argsort(start[one] - end[one], kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return start[one][order], end[one][order], rank[back]


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          vocabulary: str = VOCABULARY, sample: int = 2000, rounds: int = 3,
          smooth: float = 0.05) -> dict:
    """Per-language piece probabilities from rows with a language.

    At most about ``sample`` documents a language are learned from, picked by a hash of their
    identifier and text, so that a text of many copies counts by its share.
    Their word counts are grouped by Spark; each round tasks sum the expected uses of pieces over
    all segmentations (forward and backward sums) and a table of language x piece comes back,
    bounded by the vocabulary. Null texts and null languages are left out. With no rows at all the
    model has no language.
    """
    spark = labelled.sparkSession
    rows = renamed(labelled, doc_id=id_col, text=text_col, lang=lang_col).where("text IS NOT NULL AND lang IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(sizes)
    vocab = pieces(vocabulary)
    if not langs:
        return {"langs": [], "vocabulary": vocab, "prob": np.zeros((len(vocab), 0)), "prior": np.zeros(0)}
    share = F.create_map(*[F.lit(x) for k in langs for x in (k, min(1.0, sample / sizes[k]))])
    picked = rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < F.element_at(share, F.col("lang")) * 1e6)
    words = stored(
        picked.select("lang", F.explode(F.split(F.lower("text"), r"[^a-z\x{80}-\x{10FFFF}]+")).alias("word"))
        .where("word != ''").groupBy("lang", "word").agg(F.count("*").alias("n")), "words")

    def expect(shared):
        def run(batches):
            vocab, langs, prob = shared.value
            lattice, out = Lattice(vocab), np.zeros((len(vocab), len(langs)))
            place = {lang: k for k, lang in enumerate(langs)}
            for batch in batches:
                own = np.array([place[x] for x in batch.column("lang").to_pylist()])
                count = batch.column("n").to_numpy(zero_copy_only=False).astype(float)
                for i, j, data, start, end, first in marked(batch.column("word")):
                    of = np.searchsorted(first, np.arange(len(start)), "right") - 1 + i
                    for k in range(len(langs)):
                        mine = np.flatnonzero(own[of] == k)
                        mine = mine[np.argsort(start[mine] - end[mine], kind="stable")]
                        for p in range(0, len(mine), 4096):
                            q = mine[p: p + 4096]
                            arcs = lattice.arcs(data, start[q], end[q])
                            out[:, k] += expected(arcs, end[q] - start[q], count[of[q]], prob[:, k: k + 1])
            piece, lang = np.nonzero(out)
            yield pa.RecordBatch.from_pydict({"lang": pa.array(lang.astype(np.int32)),
                                              "piece": pa.array(piece.astype(np.int32)),
                                              "uses": pa.array(out[piece, lang])})
        return run

    prob = np.full((len(vocab), len(langs)), 1.0 / len(vocab))
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast((vocab, langs, prob))
        uses = (words.mapInArrow(expect(shared), "lang int, piece int, uses double")
                .groupBy("lang", "piece").agg(F.sum("uses").alias("uses")).toPandas())
        table = np.full(prob.shape, smooth)
        # a fixed precision, so that the order in which tasks end leaves no trace
        table[uses["piece"], uses["lang"]] += np.round(uses["uses"].to_numpy(), 6)
        prob = table / table.sum(axis=0)
    total = sum(sizes.values())
    prior = np.array([sizes[k] / total for k in langs])
    return {"langs": langs, "vocabulary": vocab, "prob": prob, "prior": prior}


def _scores(shared, text_col: str):
    def run(batches):
        langs, vocab, prob, prior = shared.value
        lattice, base = Lattice(vocab), np.log(prior)
        for batch in small_batches(batches):
            total = np.tile(base, (batch.num_rows, 1))
            for i, j, data, start, end, first in marked(text_of(batch, text_col)):
                if not len(start):
                    continue
                s, e, back = _distinct(data, start, end)
                logs = np.empty((len(s), len(langs)))
                for p in range(0, len(s), 8192):
                    a, b = s[p: p + 8192], e[p: p + 8192]
                    size = b - a
                    alpha = forward(lattice.arcs(data, a, b), len(a), int(size.max()), prob)
                    logs[p: p + 8192] = np.log(np.maximum(alpha[size, np.arange(len(a))], 1e-300))
                sums = np.zeros((len(back) + 1, len(langs)))
                np.cumsum(logs[back], axis=0, out=sums[1:])
                total[i:j] += sums[first[1:]] - sums[first[:-1]]
            best = total.argmax(axis=1)
            odds = np.exp(total - total.max(axis=1, keepdims=True))
            names = np.array(langs, object)[best]
            drop = {"text"}
            columns = {c: batch.column(c) for c in batch.schema.names if c not in drop}
            columns |= {"lang_pred": pa.array(list(names), pa.string()), "score": pa.array(1 / odds.sum(axis=1))}
            yield pa.RecordBatch.from_pydict(columns)
    return run


def predict(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text",
            whole: bool = False) -> DataFrame:
    """The language of every whole text, and its posterior probability.

    A text's probability under a language is the product over its words, runs of letters, of the sum
    over all ways to write the word as pieces. Null texts, texts without a letter, and all texts under
    a model without languages give ``und`` and score 0. Ties go to the first language by name. Rows
    that repeat give equal results; an empty table gives an empty one.

    Returns doc_id, lang_pred, score; with ``whole``, the input row as struct ``whole`` too.
    """
    own = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")] if whole else []
    text = [] if whole else [F.col(f"`{text_col}`").alias("text")]
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), *own, has_letter(F.col(f"`{text_col}`")).alias("letter"),
                       *text)
    if not model["langs"]:
        return rows.drop("text", "letter").withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0)})
    shared = docs.sparkSession.sparkContext.broadcast(
        (model["langs"], model["vocabulary"], model["prob"], model["prior"]))
    schema = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in rows.columns if c != "text")
    out = rows.mapInArrow(_scores(shared, text_col), schema + ", lang_pred string, score double")
    return out.select(
        *out.columns[: 1 + whole],
        F.when(F.col("letter"), F.col("lang_pred")).otherwise("und").alias("lang_pred"),
        F.when(F.col("letter"), F.col("score")).otherwise(0.0).alias("score"))


def confident(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text",
              least: float = 0.5) -> DataFrame:
    """Documents whose language is told with a score of ``least`` or more, all their columns kept."""
    return (predict(docs, model, id_col, text_col, whole=True)
            .where((F.col("lang_pred") != "und") & (F.col("score") >= least)).select("whole.*"))
