"""Language identification by compression.

Each language has a dictionary of raw text for zstandard. A text belongs to the language
with whose dictionary it becomes smallest; where the second best comes too close, the text
is rejected. A text without letters has no language. Letters are compared in lower case, and
what stands between them counts as one space. A text is compressed whole, in pieces of
``PIECE`` bytes, so that a long text can't serve as its own dictionary.

Dictionaries are learned from a bounded sample: of each language the ``sample_rows`` labelled
rows that come first by a hash of their id, of each at most ``sample_chars`` characters from
its start. All texts are classified whole.
"""

from __future__ import annotations

import re
from functools import cache

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crisis_posts.llm.shared import map_rows

SAMPLE_ROWS = 96
SAMPLE_CHARS = 2_000
MIN_MARGIN = 0.001
MARGIN_PERCENTILE = 0.5
FOLDS = 4
PIECE = 1_000
UNKNOWN = "und"
_LEVEL = 3
_BETWEEN = re.compile(r"[\W\d_]+")


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from learning: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def _sample(labelled: DataFrame, sample_rows: int, sample_chars: int) -> dict[str, list[str]]:
    """Learning texts per language from (doc_id, text, lang), in order of their ids.

    Rows with nulls teach nothing. The sample's ids are chosen without the texts; each task keeps at most sample_rows rows
    of a language before rows meet. What reaches the driver is bounded by both parameters.
    """
    labelled = labelled.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull()
    )
    order = Window.partitionBy("lang").orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id")
    chosen = (
        labelled.select("doc_id", "lang").withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= sample_rows)
    )
    sample = (
        labelled.select("doc_id", "lang", F.substring("text", 1, sample_chars).alias("text"))
        .join(F.broadcast(chosen.select("doc_id", "lang").distinct()), ["doc_id", "lang"])
        .distinct()
    )
    texts: dict[str, list[tuple]] = {}
    for row in sample.collect():
        texts.setdefault(row["lang"], []).append((row["doc_id"], row["text"]))
    return {lang: [text for _, text in sorted(rows)] for lang, rows in sorted(texts.items())}


def _joined(texts: dict[str, list[str]]) -> dict[str, bytes]:
    return {lang: "\n".join(own).encode() for lang, own in texts.items()}


def learn_dictionaries(
    labelled: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_chars: int = SAMPLE_CHARS
) -> dict[str, bytes]:
    """Raw dictionary per language from (doc_id, text, lang)."""
    return _joined(_sample(labelled, sample_rows, sample_chars))


def learn(
    labelled: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_chars: int = SAMPLE_CHARS
) -> tuple[dict[str, bytes], float]:
    """The dictionaries, and the margin below which texts are to be rejected.

    A learning row's margin is taken with dictionaries of the other folds' rows. The margin is
    the MARGIN_PERCENTILE of those of rightly classified rows, MIN_MARGIN at least.
    """
    texts = _sample(labelled, sample_rows, sample_chars)
    margins = []
    for fold in range(FOLDS):
        others = {k: [t for i, t in enumerate(own) if i % FOLDS != fold] for k, own in texts.items()}
        compressors = Compressors(_joined({k: own for k, own in others.items() if own}))
        for lang, own in texts.items():
            for text in own[fold::FOLDS]:
                found, margin = compressors.classify(text.encode())
                if found == lang:
                    margins.append(margin)
    least = float(np.percentile(margins, MARGIN_PERCENTILE)) if margins else 0.0
    return _joined(texts), max(MIN_MARGIN, least)


def letters(text: str) -> bytes:
    return _BETWEEN.sub(" ", text.lower()).encode()


class Compressors:
    def __init__(self, dictionaries: dict[str, bytes]):
        self.languages = sorted(dictionaries)
        self.by_language = []
        for lang in self.languages:
            raw = letters(dictionaries[lang].decode())
            data = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            settings = zstandard.ZstdCompressionParameters.from_level(
                _LEVEL, dict_size=len(raw), source_size=PIECE, write_content_size=False
            )
            data.precompute_compress(compression_params=settings)
            self.by_language.append(
                zstandard.ZstdCompressor(compression_params=settings, dict_data=data)
            )

    def classify(self, text: bytes) -> tuple[str, float]:
        """The language, and the margin by which the second best is larger, 0 to 1."""
        decoded = text.decode()
        if not self.languages or not any(map(str.isalpha, decoded)):
            return UNKNOWN, 0.0
        plain = letters(decoded)
        pieces = [plain[at : at + PIECE] for at in range(0, len(plain), PIECE)]
        sizes = [sum(len(c.compress(p)) for p in pieces) for c in self.by_language]
        best = min(range(len(sizes)), key=sizes.__getitem__)
        rest = [size for i, size in enumerate(sizes) if i != best]
        if not rest:
            return self.languages[best], 1.0
        return self.languages[best], 1.0 - sizes[best] / min(rest)


@cache
def _compressors(items: tuple[tuple[str, bytes], ...]) -> Compressors:
    return Compressors(dict(items))


def identify_language(
    documents: DataFrame, dictionaries: dict[str, bytes], min_margin: float = MIN_MARGIN
) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of each whole text.

    score is the margin, 0 to 1. rejected: the margin is below min_margin, or there is no
    letter (lang_pred 'und'), as in null and empty texts. Ties go to the first language by
    name, and have margin 0. Without dictionaries every text is 'und'. Rows with equal doc_id
    keep their number; columns besides doc_id and text are not looked at.
    """
    items = tuple(sorted(dictionaries.items()))

    def classify(rows):
        compressors = _compressors(items)
        for doc, text in rows:
            lang, margin = compressors.classify(text or b"")
            yield doc, lang, margin, lang == UNKNOWN or margin < min_margin

    schema = "doc_id long, lang_pred string, score double, rejected boolean"
    return map_rows(documents.select("doc_id", "text"), schema, classify)
