"""Packing by powers of two: every sequence is a binary-length piece of one document.

A document of ``n`` tokens is cut into pieces of ``longest`` and then into the binary digits
of what is left, longest first. A piece is a sequence by itself: its length is a power of
two, so nothing is padded and no sequence crosses documents. Pieces of one length form a
bucket, from which batches of equal shape are read.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, functions as F

from staymart.llm.common import scan

END_OF_DOCUMENT, LONGEST = 1, 2048
#: A space next to other white space, or at an end, may belong to the token before or after it.
IRREGULAR = re.compile(r"^ | \s|\s | $")
MOST_CACHED = 600_000
#: Fixed value: how text is split before merges, as the vocabulary's description gives it.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Part(dict):
    """Ids, as little-endian bytes, of what stands after a single space, found on first use.

    The first ``MOST_CACHED`` parts are remembered; the common ones are among them.
    """

    def __init__(self, encode) -> None:
        super().__init__()
        self.encode = encode

    def __missing__(self, part: str) -> bytes:
        ids = array("I", self.encode(" " + part)).tobytes()
        if len(self) < MOST_CACHED:
            self[part] = ids
        return ids


class Tokens:
    """Ids of texts as little-endian bytes, by the byte-level BPE in a ``tokenizers`` file.

    In this kind of vocabulary a single space between other characters starts a token, so
    a text is the concatenation of its parts cut before each space, and a part that was
    seen before need not be encoded again. Texts with other white space around a space are
    encoded whole. New parts go through ``tiktoken``, which is given the file's own
    vocabulary and is several times as fast on short strings; texts that name a special
    token go through ``tokenizers`` itself, which turns the name into its id.
    """

    def __init__(self, path: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            parsed = json.load(file)
        special = {x["content"] for x in parsed.get("added_tokens", [])}
        self.special = re.compile("|".join(map(re.escape, sorted(special))) or "(?!)")
        byte_of = {c: b for b, c in enumerate(byte_letters())}
        ranks = {
            bytes(byte_of[c] for c in token): i for token, i in parsed["model"]["vocab"].items() if token not in special
        }
        own = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.encode = own.encode_ordinary
        self.after_space = Part(self.encode)

    def of(self, text: str) -> bytes:
        if self.special.search(text):
            return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
        if IRREGULAR.search(text):
            return array("I", self.encode(text)).tobytes()
        first, *rest = text.split(" ")
        return array("I", self.encode(first)).tobytes() + b"".join(map(self.after_space.__getitem__, rest))


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the file: printable Latin-1 characters for
    themselves, the other bytes by the letters from 256 on, in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


@lru_cache(maxsize=2)
def tokens(path: str) -> Tokens:
    """Loaded once in a Python worker, with what it has seen so far."""
    return Tokens(path)


def cuts(n: int, longest: int = LONGEST) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of ``n`` tokens."""
    out, start = [], 0
    while n - start >= longest:
        out.append((start, longest))
        start += longest
    size = longest
    while start < n:
        size //= 2
        if n - start >= size:
            out.append((start, size))
            start += size
    return out


def pieces(docs: DataFrame, tokenizer: str, longest: int = LONGEST, with_ids: bool = True) -> DataFrame:
    """A row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    bucket`` and, if wanted, ``ids`` (little-endian unsigned 32-bit).

    ``longest`` is a power of two. A null or empty text is the end token alone. Repeated rows
    are packed each. Rows of an empty table: none. ``sequence_id`` is unique within a run: it
    comes from the place of the row in the scan, so no shuffle is needed.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "bucket"] + ["ids"] * with_ids
    tail = np.array([END_OF_DOCUMENT], "<u4").tobytes()

    def of_slice(part):
        encode, rows = tokens(tokenizer).of, []
        for doc, text in zip(part["doc_id"], part["text"]):
            ids = encode(text or "") + tail
            n = len(ids) // 4
            for start, length in cuts(n, longest):
                own = ids[4 * start : 4 * (start + length)]
                rows.append((doc, start, length, zlib.crc32(own), n, length.bit_length() - 1, own))
        return {k: [r[i] for r in rows] for i, k in enumerate(names)}

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, bucket int"
    out = scan(docs, ["doc_id", "text"], of_slice, schema + ", ids binary" * with_ids)
    return out.withColumns({"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})


def write_buckets(packed: DataFrame, path: str) -> None:
    """Sequences as Parquet, one folder per length, to be read as batches of one shape."""
    packed.write.partitionBy("bucket").parquet(path)
