"""Exact token ids and prefix token counts with a public tokenizer file.

Both operators cut a text at ASCII white space into chunks.  The tokenizer
drops white space and never joins tokens across it, so a text's ids are its
chunks' ids in order; a bounded cache per Python worker keeps the chunks that
come again.  Two operators use this:

``prefix_counts`` answers truncation and budget questions.  For each chunk a
dynamic program over its prefixes stores the token count of every prefix, and
the chunks' tables are strung together to the text's table; no prefix is ever
encoded again.  ``TokenTable`` reads such a table.

``encode`` gives the ids themselves (for the binary output).
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import byte_texts, with_columns

CACHE_CHUNKS = 200_000     # chunks that a worker remembers (frequent ones come first)
CACHE_WORDS = 600_000      # words inside chunks that it remembers
CACHE_BYTES = 64           # longer pieces are not remembered
STATES = 300_000           # word prefixes that a worker remembers,
SHARED = 8                 # up to this length
PAIRS = 500_000            # token pairs whose stability it remembers
WORD_END = "</w>"


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def vocabulary_size(path: str) -> int:
    return _tokenizer(path).get_vocab_size(with_added_tokens=True)


@lru_cache(maxsize=4)
def _special(path: str) -> list[str]:
    with open(path, encoding="utf-8") as f:
        return [t["content"] for t in json.load(f)["added_tokens"]]


class Known(dict):
    """Values of pieces of text, computed when first asked for; at most
    ``size`` of them, none of a long piece, are kept."""

    def __init__(self, compute, size: int):
        super().__init__()
        self.compute, self.size = compute, size

    def __missing__(self, key):
        value = self.compute(key)
        if len(self) < self.size and len(key) <= CACHE_BYTES:
            self[key] = value
        return value


def _chunks(text: bytes) -> list[bytes]:
    """Chunks between ASCII white space; A-Z are lowered as the tokenizer does,
    unless the text may hold a special token, which is matched before that."""
    return (text if b"<|" in text else text.lower()).split()


# ---- ids -----------------------------------------------------------------------

#: Chunks of lower-case Latin letters, digits and ASCII punctuation are in normal
#: form; on them this is the tokenizer's own splitting pattern.
_PLAIN = re.compile("[!-@\\[-`a-z{-~ß-öø-ÿ]+")
_SPLIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


def _byte_symbols() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves,
    the others for the code points from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = (b for b in range(256) if b not in shown)
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(rest)}


_SYMBOLS = "".join(_byte_symbols()[b] for b in range(256))


def _mapped(word: str) -> str:
    return word.encode().decode("latin-1").translate(_SYMBOLS)


@lru_cache(maxsize=4)
def _ids(path: str) -> Known:
    """Chunk -> its ids as little-endian unsigned 32-bit integers.  The words of
    plain chunks go to the tokenizer's model, other chunks through all of it."""
    tok = _tokenizer(path)
    model = tok.model
    words = Known(lambda w: array("I", [t.id for t in model.tokenize(_mapped(w))]).tobytes(), CACHE_WORDS)

    def of(chunk: bytes) -> bytes:
        text = chunk.decode("utf-8", "replace")
        if _PLAIN.fullmatch(text) and "<|" not in text:
            return b"".join([words[w] for w in _SPLIT.findall(text)])
        return array("I", tok.encode(text, add_special_tokens=False).ids).tobytes()

    return Known(of, CACHE_CHUNKS)


def encode(texts: list[bytes], path: str) -> list[bytes]:
    """Token ids of each text as little-endian unsigned 32-bit integers."""
    get = _ids(path).__getitem__
    return [b"".join(map(get, _chunks(t))) for t in texts]


# ---- prefix dynamic programming ---------------------------------------------------

class PrefixCounter:
    """Token counts of all prefixes of a word by dynamic programming.

    Byte-pair encoding is characterised by its neighbours: a token sequence is
    the encoding of its text exactly if every pair of neighbours encodes to
    itself.  So the encoding of a prefix is that of a shorter prefix plus one
    vocabulary token whose pair with the shorter prefix's last token is stable;
    there is exactly one such token.  Every prefix has a state for a word that
    goes on; the word end mark closes one more step per prefix.  States of common
    prefixes are shared between words.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.ranks = {tuple(m): k for k, m in enumerate(model["merges"])}
        #: token -> (rank of the merge that makes it, its left part, its right part)
        self.made = {a + b: (k, a, b) for (a, b), k in reversed(self.ranks.items())}
        self.longest = max(map(len, self.vocab))
        self.pairs: dict[tuple[str, str], bool] = {}
        #: prefix -> (last token, tokens if the word goes on, tokens if it ends here)
        self.states: dict[str, tuple[str, int, int]] = {"": ("", 0, 0)}

    def merged(self, symbols: list[str]) -> list[str]:
        """Plain byte-pair merging, lowest rank first (for short symbol lists)."""
        s = list(symbols)
        while len(s) > 1:
            rank, k = min((self.ranks.get((a, b), 1 << 60), k) for k, (a, b) in enumerate(zip(s, s[1:])))
            if rank == 1 << 60:
                break
            pair = (s[k], s[k + 1])
            out, i = [], 0
            while i < len(s):
                if i + 1 < len(s) and (s[i], s[i + 1]) == pair:
                    out.append(s[i] + s[i + 1])
                    i += 2
                else:
                    out.append(s[i])
                    i += 1
            s = out
        return s

    @staticmethod
    def symbols(token: str) -> list[str]:
        if token.endswith(WORD_END) and len(token) > len(WORD_END):
            body = token[: -len(WORD_END)]
            return [*body[:-1], body[-1] + WORD_END]
        return list(token)

    def stable(self, a: str, b: str) -> bool:
        """Whether the neighbours a, b are the encoding of their own text.

        Their merges are undone from the last to the first, a's to its right
        part and b's to its left part.  The neighbours would have been merged
        with each other if the rule for the two parts at the border came before
        the merge just undone, or, for one and the same rule, further left."""
        if len(self.pairs) > PAIRS:
            self.pairs.clear()
        self.pairs[(a, b)] = ok = self._stable(a, b)
        return ok

    def _stable(self, a: str, b: str) -> bool:
        if not a:
            return self.merged(self.symbols(b)) == [b]
        ranks, made, before = self.ranks, self.made, len(self.ranks)
        while ranks.get((a, b), before) >= before:
            made_a, made_b = made.get(a), made.get(b)
            if made_a is None and made_b is None:
                return True
            if made_b is None or (made_a is not None and made_a[0] > made_b[0]):
                before, a = made_a[0], made_a[2]
            else:
                before, b = made_b[0] + 1, made_b[1]
        return False

    def _step(self, word: str, k: int, end: str, inner: list) -> tuple[str, int]:
        vocab, pairs = self.vocab, self.pairs
        for j in range(max(0, k - self.longest), k):
            t = word[j:k] + end
            if t in vocab:
                last = inner[j][0]
                if pairs.get((last, t)) or ((last, t) not in pairs and self.stable(last, t)):
                    return t, inner[j][1] + 1
        raise ValueError(f"no token ends the prefix {word[:k]!r}")

    def counts(self, word: str) -> list[int]:
        """counts[k]: tokens of the word's first k symbols, taken as a whole word."""
        states = self.states
        inner = [states[""]]
        for k in range(1, len(word) + 1):
            state = states.get(word[:k]) if k <= SHARED else None
            if state is None:
                t, n = self._step(word, k, "", inner)
                state = (t, n, self._step(word, k, WORD_END, inner)[1])
                if k <= SHARED and len(states) < STATES:
                    states[word[:k]] = state
            inner.append(state)
        return [s[2] for s in inner]


@lru_cache(maxsize=2)
def _counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


_CONTRACTIONS = frozenset(("'s", "'t", "'re", "'ve", "'m", "'ll", "'d"))


def _normal(text: str, path: str) -> str:
    return text if _PLAIN.fullmatch(text) else _tokenizer(path).normalizer.normalize_str(text)


def _pieces(text: str, path: str) -> list[tuple[str, str, int, int]]:
    """(word, mapped word, begin, end) of the words of a normalized text."""
    if _PLAIN.fullmatch(text):
        return [(m[0], _mapped(m[0]), m.start(), m.end()) for m in _SPLIT.finditer(text)]
    return [(text[a:b], w, a, b) for w, (a, b) in _tokenizer(path).pre_tokenizer.pre_tokenize_str(text)]


def _steps(counts: list[int]) -> bytes:
    """Changes between neighbouring counts as signed bytes (no token is so long
    that a count could jump further)."""
    return bytes([(y - x) & 255 for x, y in zip(counts, counts[1:])])


def _word_table(word: str, mapped: str, path: str) -> tuple[bytes, int]:
    """(steps, tokens) of one word of a normalized text."""
    now = _counter(path).counts(mapped)
    if word in _CONTRACTIONS:                   # its parts would be split otherwise
        counts = [0] + [_prefix_total(word[:k], path) for k in range(1, len(word))] + [now[-1]]
    elif len(mapped) == len(word):              # one byte per character
        counts = now
    else:
        counts, end = [0], 0
        for ch in word:
            end += len(ch.encode())
            counts.append(now[end])
    return _steps(counts), now[-1]


@lru_cache(maxsize=2)
def _word_tables(path: str) -> Known:
    return Known(lambda word: _word_table(word, _mapped(word), path), CACHE_WORDS)


def _chunk_table(chunk: bytes, path: str) -> tuple[bytes, int]:
    """(steps, tokens): the change of the token count at each character of the
    normalized chunk as signed bytes, and the count of the whole chunk.  A word
    starts from the count that the word before it ends with, so the tables of a
    chunk's words are strung together."""
    raw = chunk.decode("utf-8", "replace")
    if _PLAIN.fullmatch(raw) and "<|" not in raw:
        known = _word_tables(path)
        tables = [known[w] for w in _SPLIT.findall(raw)]
        return b"".join([t[0] for t in tables]), sum([t[1] for t in tables])
    steps, total = b"", 0
    for piece, special in _split_special(raw, _special(path)):
        if special:                             # one token once complete; its parts before that
            steps += _steps([0] + [_prefix_total(piece[:k], path) for k in range(1, len(piece))] + [1])
            total += 1
            continue
        text = _normal(piece, path)
        at = 0
        for word, mapped, a, b in _pieces(text, path):
            table, n = _word_table(word, mapped, path)
            steps += bytes(a - at) + table      # white space that the tokenizer drops
            total += n
            at = b
        steps += bytes(len(text) - at)
    return steps, total


@lru_cache(maxsize=2)
def _tables(path: str) -> Known:
    return Known(lambda chunk: _chunk_table(chunk, path), CACHE_CHUNKS)


def _prefix_total(text: str, path: str) -> int:
    return sum(_counter(path).counts(mapped)[-1] for _, mapped, _, _ in _pieces(_normal(text, path), path))


def _split_special(text: str, special: list[str]) -> Iterator[tuple[str, bool]]:
    while text:
        found = [(k, -len(s), s) for s in special if (k := text.find(s)) >= 0]
        if not found:
            yield text, False
            return
        k, _, s = min(found)
        if k:
            yield text[:k], False
        yield s, True
        text = text[k + len(s):]


def _counts(steps: bytes) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(np.frombuffer(steps, np.int8), dtype=np.int64)))


def longest_prefix(steps: bytes, budget: int) -> int:
    """Characters of the longest prefix of at most ``budget`` tokens."""
    return int(np.flatnonzero(_counts(steps) <= budget)[-1])


class TokenTable:
    """Exact token counts of every prefix of a normalized text."""

    def __init__(self, steps: bytes):
        self.counts = _counts(zlib.decompress(steps))

    def tokens(self, chars: int) -> int:
        """Tokens of the first ``chars`` characters."""
        return int(self.counts[chars])

    def longest_prefix(self, budget: int) -> int:
        """Characters of the longest prefix of at most ``budget`` tokens."""
        return int(np.flatnonzero(self.counts <= budget)[-1])

    def fits(self, budget: int) -> bool:
        return bool(self.counts[-1] <= budget)


def prefix_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                  budget: int = 2048, with_table: bool = True) -> DataFrame:
    """One row per document row: id, n_bytes (UTF-8), n_tokens, budget_chars
    (characters of the longest prefix of at most ``budget`` tokens), and the
    prefix table ``steps`` (if ``with_table``): the change of the token count at
    every character, zlib-packed; ``TokenTable`` reads it.  Prefixes are those of
    the text in the tokenizer's normal form with white space runs as one blank.

    NULL counts as an empty text (0 bytes, 0 tokens, empty table); equal rows
    stay separate; special strings in a text count as the library's default
    does (one token).  One pass, no shuffle.
    """
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = _tables(tokenizer_path).__getitem__
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                b = batch.slice(k, 500)
                texts = byte_texts(b)
                tables = [list(map(get, _chunks(t))) for t in texts]
                steps = [b"\0".join([x[0] for x in t]) for t in tables]
                totals = [sum([x[1] for x in t]) for t in tables]
                new = {"n_bytes": pa.array([len(t) for t in texts], pa.int64()),
                       "n_tokens": pa.array(totals, pa.int64()),
                       "budget_chars": pa.array([len(s) if n <= budget else longest_prefix(s, budget)
                                                 for s, n in zip(steps, totals)], pa.int64())}
                if with_table:
                    new["steps"] = pa.array([zlib.compress(s, 1) for s in steps], pa.binary())
                yield with_columns(b, ["id"], **new)

    id_type = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"id {id_type}, n_bytes long, n_tokens long, budget_chars long" + ", steps binary" * with_table)
