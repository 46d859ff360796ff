"""Language identification by compression.

Each language has a zstandard raw-content dictionary, a bounded stretch of its labelled text, in
lower case like all that it is held against. A text is cut into blocks, each block is compressed with every dictionary, and the language whose
summed size is smallest wins. ``score`` is a soft-max over the languages' bytes per character;
where the runner-up is within ``MARGIN`` of the winner, ``rejected`` is true.
"""

from __future__ import annotations

import numpy as np
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import map_batches

BLOCK = 2048
LEVEL = 6
#: Bounds of the fit: documents of a language, characters of each and bytes of a dictionary. All languages are learned.
FIT_DOCS = 64
FIT_CHARS = 1024
DICTIONARY_BYTES = 65_536
MARGIN = 0.01
SHARPNESS = 40.0


def fit(docs: DataFrame) -> dict[str, bytes]:
    """Raw dictionaries by language from the rows (doc_id, text, lang) that may be learned from.

    Of every language the ``FIT_DOCS`` documents whose hashed ids come first; rows without text,
    without letters or without lang are left out. The ids are chosen before the texts are read.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    order = F.xxhash64(F.col("doc_id").cast("string"))
    first = Window.partitionBy("lang").orderBy("h", "doc_id")
    ids = (
        known.select("lang", "doc_id", order.alias("h"))
        .withColumn("n", F.row_number().over(first))
        .where(F.col("n") <= FIT_DOCS)
        .select("doc_id", "lang", "h")
    )
    rows = (
        known.select("doc_id", "lang", F.substring("text", 1, FIT_CHARS).alias("text"))
        .join(F.broadcast(ids), ["doc_id", "lang"])
        .select("lang", "h", "text")
        .collect()
    )
    texts: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: (r.lang, r.h, r.text)):
        texts.setdefault(r.lang, []).append(r.text)
    return {k: "\n".join(v).lower().encode("utf-8", "surrogatepass")[-DICTIONARY_BYTES:] for k, v in texts.items()}


def _compressor(raw: bytes) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False)


def predict(docs: DataFrame, model: dict[str, bytes]) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of every whole text.

    A null text, one without a letter, or a model without languages gives ``und`` with score 0 and
    rejected; equal sizes go to the language that sorts first. One row a row of ``docs``, repeated or
    not; a text of any length is compressed block by block.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def start():
        names = sorted(model)
        coders = [_compressor(model[k]) for k in names]

        def one(text):
            if not names or not text or not any(map(str.isalpha, text)):
                return "und", 0.0, True
            raw = text.lower().encode("utf-8", "surrogatepass")
            sizes = np.zeros(len(names))
            for at in range(0, len(raw), BLOCK):
                block = raw[at : at + BLOCK]
                sizes += [len(c.compress(block)) for c in coders]
            best = int(np.argmin(sizes))
            rate = sizes / sizes[best]
            rest = np.delete(rate, best)
            share = float(1 / np.exp(-SHARPNESS * (rate - 1)).sum())
            return names[best], share, bool(len(rest) and rest.min() < 1 + MARGIN)

        def step(ids, texts):
            return ids, *zip(*map(one, texts), strict=True)

        return step

    return map_batches(docs, ["doc_id", "text"], f"doc_id {kind}, lang_pred string, score double, rejected boolean", start)
