"""Token counts of whole texts; huge ones are encoded in overlapping chunks that are spliced exactly."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# A text of more characters is huge and cut into chunks of this size.
CHUNK = 65_536
# Characters two neighbouring chunks share at first; doubled as long as they do not align.
OVERLAP = 256
# Tokens over which a text counts as long.
LIMIT = 1024
# Parts of texts whose counts a task remembers, and the most characters of one. When full, it starts anew.
REMEMBERED = 300_000
SHORT = 32

# Before a blank between two visible characters: see pieces().
_CUT = re.compile(r"(?<=\S)(?= \S)")


def load(path: str):
    """The tokenizer with nothing cut or padded; one thread, since tasks share the cores."""
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


Piece = tuple[int, int]  # where a piece of the text ends, and how many tokens it has


def encode(tokenizer, text: str) -> list[Piece]:
    """The pieces into which the tokenizer cuts ``text`` before it looks for tokens, with their tokens.

    Tokens never reach over the end of a piece, and how a text goes on after the end of a piece does
    not depend on what came before it.
    """
    found: list[Piece] = []
    encoding = tokenizer.encode(text, add_special_tokens=False)
    last = None
    for word, (_, end) in zip(encoding.word_ids, encoding.offsets, strict=True):
        if word == last:
            found[-1] = (end, found[-1][1] + 1)
        else:
            found.append((end, 1))
            last = word
    return found


def spliced(tokenizer, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of ``text``, which is longer than a chunk, without encoding it in one go.

    All pieces of a chunk are those of the whole text, but for the last few, which its end may have
    cut; the first few of the next chunk may be wrong too, since it began anywhere. Where a piece
    ends at the same place in both, and the one on the left lies ``guard`` clear of the end of its
    chunk (more than a special string or a look ahead), both have the true end there, and from a true end on the right chunk is right. The left
    chunk counts up to the last such place, the right one from it. Without one, the right chunk
    starts anew, twice as far to the left; from the left chunk's own beginning, the chunk is grown.
    The right chunk always reaches a chunk beyond the end of the left one, so each round gets on.
    """
    special = max((len(t.content) for t in tokenizer.get_added_tokens_decoder().values()), default=0)
    guard = special + 2
    total, start, size = 0, 0, chunk  # start: a true end of a piece
    left = encode(tokenizer, text[:size])
    while start + size < len(text):
        end, shared = start + size, overlap
        while True:
            if shared >= size:
                size *= 2
                left = encode(tokenizer, text[start : start + size])
                break
            begin = end - shared
            right = encode(tokenizer, text[begin : end + chunk])
            ends = {begin + e for e, _ in right}
            safe = [start + e for e, _ in left if begin < start + e <= end - guard and start + e in ends]
            if safe:
                at = safe[-1]
                total += sum(n for e, n in left if start + e <= at)
                left = [(begin + e - at, n) for e, n in right if begin + e > at]
                start, size = at, end + chunk - at
                break
            shared *= 2
    return total + sum(n for _, n in left)


def pieces(text: str) -> list[str]:
    """``text`` cut before every blank that stands between two visible characters.

    With byte-level pieces a blank goes with the letters, digits or signs after it, and white space is
    only gathered with more of it. So a single blank after a visible character always begins a piece,
    and the visible character always ends one: the parts can be encoded one by one.
    """
    return _CUT.split(text)


class Counter:
    """Counts tokens; remembers the parts of texts it has seen, as words come again and again."""

    def __init__(self, tokenizer, chunk: int = CHUNK, overlap: int = OVERLAP):
        self.tokenizer, self.chunk, self.overlap = tokenizer, chunk, overlap
        self.known: dict[str, int] = {}

    def count(self, texts: list[str]) -> list[int]:
        parts = [pieces(t) if len(t) <= self.chunk else None for t in texts]
        new = list({p for ps in parts if ps is not None for p in ps} - self.known.keys())
        counts = dict(zip(new, map(len, self.tokenizer.encode_batch_fast(new, add_special_tokens=False)), strict=True))
        look = lambda p: self.known[p] if p in self.known else counts[p]
        found = [
            spliced(self.tokenizer, t, self.chunk, self.overlap) if ps is None else sum(map(look, ps))
            for t, ps in zip(texts, parts, strict=True)
        ]
        short = {p: n for p, n in counts.items() if len(p) <= SHORT}
        if len(self.known) + len(short) > REMEMBERED:
            self.known = {}
        self.known.update(short)
        return found


def token_counts(
    docs: DataFrame,
    tokenizer: Callable[[], str],
    doc_id: str = "doc_id",
    text: str = "text",
    limit: int = LIMIT,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """One row (doc_id, n_bytes, n_tokens, over_limit) per row of ``docs``.

    ``tokenizer`` gives the path of a byte-level tokenizer file where a task runs. Tokens are those of
    the library for the whole text, without begin or end; special strings in texts are its special
    tokens, as it does by default. Null text is empty and has none. Ids may be null or repeat, rows
    equal in all columns come back as often; other columns are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(load(tokenizer()), chunk, overlap)
        for batch in batches:
            counts = pa.array(counter.count([t or "" for t in batch.column(2).to_pylist()]), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], counts], names=["doc_id", "n_bytes", "n_tokens"])

    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    narrow = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.octet_length(whole).cast("bigint").alias("n_bytes"), whole.alias("text"))
    counted = narrow.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
