"""Token counts of whole texts, without keeping the tokens.

Each Arrow batch is cut into calls of about equal bytes. A long text is first split where
the tokeniser's pattern always ends a token, so its pieces count like the whole.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Bytes of text given to the tokeniser in one call.
CALL_BYTES = 1 << 18
#: Texts over so many characters are split.
LONG_TEXT = 1 << 15

#: Special tokens of the rank files, fixed values
SPECIAL = {"<|endoftext|>": 50256}


def counter(path: str) -> Callable[[list[str]], list[int]]:
    """Counts for a list of texts, by the library that the kind of file belongs to.

    Strings of special tokens inside a text are handled as the library does by default for
    ``.json`` and ``.tiktoken`` (one token) and for ``.model`` (ordinary text); none is added.
    """
    if path.endswith(".tiktoken"):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        coding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)
        return lambda texts: [len(coding.encode(text, allowed_special="all")) for text in texts]
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        return lambda texts: [len(x) for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda texts: [len(x) for x in pieces.encode(texts, num_threads=1)]


def safe_pieces(text: str, most: int = LONG_TEXT) -> Iterator[str]:
    """Split before a space that follows an ASCII letter or digit, at ``most`` characters or the next such place.

    The pattern ends a token there whatever stands around it: letters, digits and contractions
    never take a space in, and the space opens the next token. Special tokens hold no space.
    """
    at = 0
    while len(text) - at > most:
        cut = text.find(" ", at + most)
        while cut > 0 and not (text[cut - 1].isascii() and text[cut - 1].isalnum()):
            cut = text.find(" ", cut + 1)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


def count_batch(column: pa.Array, count: Callable[[list[str]], list[int]], split: bool = True) -> np.ndarray:
    totals = np.zeros(len(column), np.int64)
    calls: list[str] = []
    rows: list[int] = []
    size = 0
    for row, text in enumerate(column):
        text = text.as_py()
        if not text:
            continue
        for piece in safe_pieces(text) if split else (text,):
            calls.append(piece)
            rows.append(row)
            size += len(piece)
            if size >= CALL_BYTES:
                np.add.at(totals, rows, count(calls))
                calls, rows, size = [], [], 0
    if calls:
        np.add.at(totals, rows, count(calls))
    return totals


def count_tokens(docs: DataFrame, vocabulary: str, text: str = "text", limit: int = 512) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    ``vocabulary`` is the path of a tokeniser file that every executor has. A null text
    counts as empty: 0 bytes, 0 tokens. Columns of ``docs`` with the name of a result
    column are replaced; rows are independent, so repeated rows and empty tables need no
    care. The text goes to Python alone, and only lengths come back.
    """
    # pieces of SentencePiece may depend on the start of the text, so only the others are split
    split = not vocabulary.endswith(".model")

    @F.arrow_udf("bigint")
    def lengths(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        count = counter(vocabulary)
        for column in batches:
            yield pa.array(count_batch(column, count, split))

    return docs.withColumns(
        {"n_bytes": F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint"), "n_tokens": lengths(F.col(text))}
    ).withColumn("over_limit", F.col("n_tokens") > limit)
