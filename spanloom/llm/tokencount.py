"""Token counts: the library counts the pieces of each distinct pre-token once; documents only sum them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .postings import chunk_postings, chunk_sums

LIMIT = 2048


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    """Where the public tokenizer file lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def token_counts(docs: DataFrame, tokenizer_file: str | None = None, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) per row of ``docs``, tokens as the tokenizers library gives them for the whole text.

    A pre-token here is what stands between ASCII white space, a final full stop or comma on its own: the tokenizer lower-cases,
    drops white space and joins no piece over it or from a letter to a mark, so a text's count is the sum over its pre-tokens.
    This holds only for tokenizers of that kind (word_bpe_49k.json is one).
    Special strings in a text count as the library's default has them; nothing is added, cut or padded. A null or empty text
    has 0 bytes and 0 tokens. Repeated rows and null ids are returned as often as they come; an empty table gives an empty
    result; other columns are ignored. The file is read on each executor, so it must lie at the same place on all.
    """
    path = tokenizer_file or vocabulary_path()

    def value():
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()

        def pieces(chunks: list[bytes]) -> np.ndarray:
            return np.array([len(x.ids) for x in tokenizer.encode_batch_fast([c.decode("utf-8", "replace") for c in chunks], add_special_tokens=False)], np.float64)[:, None]

        return pieces

    sums = chunk_sums(chunk_postings(docs, "tokens", id_col, text_col), value, 1, "<u4")
    counted = sums.select("doc_id", F.col("size").alias("n_bytes"), F.col("sums")[0].cast("long").alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
