"""Language identification with bit-sliced Bloom filters over byte n-grams.

Every language has a Bloom filter of its typical n-grams. The filters are stored sliced: one
integer per slot, one bit per language, so that the AND of an n-gram's slots is the mask of all
languages that contain it. A text belongs to the language with the most n-grams, after the
filter's expected false positives are taken off.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltery.llm.common import has_letter, packed, slices, texts_of, unpacked, with_columns_of

GRAM = 4
#: An n-gram is typical if it makes up this share of a language's n-grams, which bounds the
#: n-grams of a language by one over it, and this part of the largest share in any language.
LEAST_SHARE, LEAST_OF_BEST = 4e-6, 0.25
SLOT_BITS = 21
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
LANGUAGES = 63
BYTES_AT_ONCE, GRAMS_AT_ONCE = 1 << 20, 1 << 22
UNDETERMINED = "und"
#: Score below which a text is in none of the languages. Of 10,000 labelled texts at sf0.1 all but
#: one (``A.``, too short for an n-gram) score 0.41 or more, of 200 base64 strings none above 0.22.
LEAST_SCORE = 0.3

_KEEP = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def grams_of(text: str) -> Iterator[np.ndarray]:
    """The n-grams of a whole text, as integers, in pieces: letters and single spaces only."""
    data = text.lower().encode("utf-8", "surrogatepass").translate(_KEEP)
    data = b" " + b" ".join(data.split()) + b" "
    for part in slices(max(0, len(data) - GRAM + 1), BYTES_AT_ONCE):
        view = np.frombuffer(data, np.uint8, part.stop - part.start + GRAM - 1, part.start).astype(np.uint32)
        grams = view[: len(view) - GRAM + 1].copy()
        for i in range(1, GRAM):
            grams |= view[i : len(view) - GRAM + 1 + i] << np.uint32(8 * i)
        yield grams


def slots_of(grams: np.ndarray) -> list[np.ndarray]:
    wide = grams.astype(np.uint64)
    return [((wide + np.uint64(1)) * m >> np.uint64(64 - SLOT_BITS)).astype(np.int64) for m in MULTIPLIERS]


@dataclass
class Filters:
    """Languages in code-point order, the sliced filters, and each language's false positive rate."""

    languages: list[str]
    masks: np.ndarray
    false_rate: np.ndarray

    def shares(self, text: str) -> np.ndarray:
        """Per language, the corrected share of the text's n-grams that it contains."""
        hits, total = np.zeros(self.masks.itemsize * 8, np.int64), 0
        for grams in grams_of(text):
            found = self.masks[slots_of(grams)[0]]
            for slots in slots_of(grams)[1:]:
                found = found & self.masks[slots]
            bits = np.unpackbits(found.view(np.uint8).reshape(len(found), -1), axis=1, bitorder="little")
            hits += bits.sum(axis=0, dtype=np.int64)
            total += len(grams)
        corrected = (hits[: len(self.languages)] / max(total, 1) - self.false_rate) / (1 - self.false_rate)
        return np.clip(corrected, 0, 1)


def learn(docs: DataFrame, text_column: str = "text", lang_column: str = "lang") -> Filters:
    """Filters from all rows with a language; rows without one are not used.

    n-grams are counted over all texts. The driver receives the languages (at most
    ``LANGUAGES``; more are an error) and the filters, whose size is fixed.
    """
    rows = docs.where(F.col(lang_column).isNotNull()).select(
        F.col(lang_column).cast("string").alias("lang"), F.col(text_column).cast("string").alias("text")
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        size: dict[str, int] = {}

        def close(lang: str) -> pa.RecordBatch:
            grams, counts = np.unique(np.concatenate(held.pop(lang)), return_counts=True)
            size.pop(lang)
            return pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(grams)), pa.array(grams.astype(np.int64)), pa.array(counts.astype(np.int64))],
                names=["lang", "gram", "n"],
            )

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                for grams in grams_of(text.as_py() or ""):
                    held.setdefault(lang, []).append(grams)
                    size[lang] = size.get(lang, 0) + len(grams)
                    if size[lang] >= GRAMS_AT_ONCE // 4 or sum(size.values()) >= GRAMS_AT_ONCE:
                        yield close(max(size, key=size.get))
        for lang in list(held):
            yield close(lang)

    counts = rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    totals = rows.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("size"))
    languages = sorted(row.lang for row in totals.limit(LANGUAGES + 1).collect())
    if len(languages) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    width = np.dtype(next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if np.dtype(t).itemsize * 8 >= len(languages)))
    masks = np.zeros(1 << SLOT_BITS, width)
    if languages:
        bits = F.array(*[F.lit(1 << i).cast("long") for i in range(len(languages))])
        bit = F.element_at(bits, F.array_position(F.lit(languages), F.col("lang")).cast("int"))
        shares = counts.join(F.broadcast(totals), "lang").withColumn("share", F.col("n") / F.col("size"))
        typical = (
            shares.groupBy("gram")
            .agg(F.max("share").alias("best"), F.collect_list(F.struct("share", bit.alias("bit"))).alias("found"))
            .select(
                "gram",
                F.aggregate(
                    F.filter("found", lambda x: (x.share >= LEAST_SHARE) & (x.share >= LEAST_OF_BEST * F.col("best"))),
                    F.lit(0).cast("long"),
                    lambda mask, x: mask.bitwiseOR(x.bit),
                ).alias("mask"),
            )
            .where("mask <> 0")
        )
        filled = typical.mapInArrow(_slots, "slot long, mask long").groupBy("slot").agg(F.bit_or("mask").alias("mask"))
        found = filled.toPandas()
        masks[found["slot"].to_numpy()] = found["mask"].to_numpy(np.int64).view(np.uint64).astype(width)
    fill = [float(((masks >> width.type(i)) & width.type(1)).mean()) for i in range(len(languages))]
    return Filters(languages, masks, np.array(fill) ** len(MULTIPLIERS))


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for slots in slots_of(batch.column("gram").to_numpy(zero_copy_only=False).astype(np.uint32)):
            yield pa.RecordBatch.from_arrays([pa.array(slots), batch.column("mask")], names=["slot", "mask"])


def predict(docs: DataFrame, filters: Filters, text_column: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with ``lang_pred`` and ``score`` (0 to 1).

    The score is the corrected share of the text's n-grams that are typical of the language.
    Equal shares go to the first language in code-point order. ``und`` with score 0 stands for
    NULL texts, texts without a letter, and anything when no language was learned. Texts are read
    whole; repeated rows are judged each; other columns may have any name, and those named
    ``lang_pred`` or ``score`` are replaced. An empty table gives an empty result.
    """
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            names, scores = [], []
            for value in texts_of(batch, kept, text_column):
                text = value.as_py()
                if text is None or not model.languages or not has_letter(text):
                    names.append(UNDETERMINED)
                    scores.append(0.0)
                    continue
                shares = model.shares(text)
                best = int(shares.argmax())
                names.append(model.languages[best])
                scores.append(float(shares[best]))
            yield with_columns_of(batch, ["row"], lang_pred=pa.array(names, pa.string()), score=pa.array(scores, pa.float64()))

    rows = packed(docs, kept)
    out = rows.select("row", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    return rows.mapInArrow(label, out).select(*unpacked(kept), "lang_pred", "score")


def recognised(docs: DataFrame, filters: Filters, text_column: str = "text") -> DataFrame:
    """The rows of ``docs``, unchanged, whose language :func:`predict` determines with ``LEAST_SCORE``."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(row.alias("_row"), F.col(text_column).cast("string").alias("_text"))
    found = predict(rows, filters, "_text").where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= LEAST_SCORE))
    return found.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])
