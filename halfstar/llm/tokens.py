"""Token counts by map-side lookup of pre-token lengths."""

from __future__ import annotations

import os
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Pre-tokens a worker remembers before it starts anew.
CACHE_WORDS = 1_000_000
#: Code points looked at together; a longer text is cut at white space, where no pre-token crosses.
PIECE = 1 << 20

#: Fixed value: how word_bpe_49k.json cuts lower-cased text.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Latin texts, in which lower-casing and composition act on single characters in the same way
#: here and in the library. Any other character sends the text to the library as a whole.
PLAIN = re.compile("[\\t\\n\\r\\x20-\\x7e\\xa1-\\xac\\xae-\\xff\\u0100-\\u012f\\u0131-\\u0148\\u014a-\\u017e]*")
_CUT = re.compile(r"[\t\n\r ]")


class _Lengths:
    """Tier one: lengths shipped with the task; tier two: what this worker has encoded itself."""

    def __init__(self, frequent: dict[str, int], tokenizer):
        self.frequent, self.tokenizer = frequent, tokenizer
        self.known = dict(frequent)
        ends = [w.endswith("</w>") for w, _ in sorted(tokenizer.get_vocab().items(), key=lambda e: e[1])]
        self.ends = np.array(ends)

    def learn(self, words: set[str]) -> None:
        """Encode the misses in one call: the token that ends a pre-token says so in its spelling."""
        new = list(words.difference(self.known))
        if len(self.known) + len(new) > len(self.frequent) + CACHE_WORDS:
            self.known = dict(self.frequent)
            new = list(words.difference(self.known))
        for i in range(0, len(new), 10_000):
            part = new[i : i + 10_000]
            ids = np.array(self.tokenizer.encode(" ".join(part), add_special_tokens=False).ids)
            last = np.flatnonzero(self.ends[ids])
            if len(last) == len(part):
                self.known.update(zip(part, np.diff(last, prepend=-1).tolist()))
            else:  # some pre-token is not cut alike beside others
                for w in part:
                    self.known[w] = len(self.tokenizer.encode(w, add_special_tokens=False).ids)


def frequent_lengths(tokenizer) -> dict[str, int]:
    """Lengths of the pre-tokens that were frequent enough to get an entry of the vocabulary.

    The table is bounded by the vocabulary (49,408 entries) and encoded by the
    library, so an entry that the merges do not reach has its true length.
    """
    words = [w.removesuffix("</w>") for w in tokenizer.get_vocab() if w.endswith("</w>")]
    words = [w for w in words if w.isascii() and w.isalnum()]  # others are spelled in the byte alphabet
    return {w: len(e.ids) for w, e in zip(words, tokenizer.encode_batch(words, add_special_tokens=False))}


def _pieces(text: str):
    at = 0
    while len(text) - at > PIECE:
        cut = _CUT.search(text, at + PIECE)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def counter(spec: str, frequent: dict[str, int]) -> Callable[[list[str]], list[int]]:
    """Function of texts giving their tokens; ``spec`` is the tokenizer's JSON."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import regex
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(spec)
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    lengths = _Lengths(frequent, tokenizer)
    cut = regex.compile(PRE_TOKEN).findall

    def flush(out: list[int], held: list[tuple[int, list[str]]]) -> None:
        lengths.learn(set().union(*(words for _, words in held)))
        known = lengths.known.__getitem__
        for i, words in held:
            out[i] += sum(map(known, words))
        held.clear()

    def count(texts: list[str]) -> list[int]:
        out, held, size = [0] * len(texts), [], 0
        for i, text in enumerate(texts):
            if not PLAIN.fullmatch(text) or any(s in text for s in special):
                out[i] = len(tokenizer.encode(text, add_special_tokens=False).ids)
                continue
            for piece in _pieces(text):
                held.append((i, cut(piece.lower())))
                size += len(piece)
                if size > PIECE:
                    flush(out, held)
                    size = 0
        flush(out, held)
        return out

    return count


def token_counts(docs: DataFrame, tokenizer_file: str, limit: int = 2048) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` per row of ``docs(doc_id, text)``.

    The lengths of frequent pre-tokens and the tokenizer (a few MB, bounded by
    the vocabulary file) are broadcast; a pre-token outside that table is
    encoded once per worker and remembered in a bounded cache. No pre-token is
    shuffled. Counts equal the library's for the whole text, special strings
    inside texts included, without begin, end or added tokens.

    A null or empty text has no bytes and no tokens; null and repeated ids are
    kept as they are; an empty table gives none; other columns are not read.
    """
    from tokenizers import Tokenizer

    with open(tokenizer_file, encoding="utf-8") as file:  # the driver's copy; workers get it by broadcast
        spec = file.read()
    shared = docs.sparkSession.sparkContext.broadcast((spec, frequent_lengths(Tokenizer.from_str(spec))))

    def run(batches):
        count = counter(*shared.value)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            tokens = count(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array([n > limit for n in tokens], pa.bool_()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean"
    )
