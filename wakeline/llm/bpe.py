"""BPE encoding by backtracking over longest matches, and decoding by an offset table.

A word's tokens are found from the left: of the tokens that match at a position (one Aho-Corasick pass gives
all matches of a word), the longest comes first, then ever shorter ones. A token may follow another only if
that pair is compatible: merging the two tokens' text from single units would leave the border between them.
A position from which nothing fits is struck off and the last token is taken back. As every prefix of a word
has one valid encoding, each position is struck off once at most, so the work is linear in the word's length.
"""

from __future__ import annotations

import json
import string
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache, partial

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, normalizers, pre_tokenizers

_FOREVER = 1 << 30
#: Unicode's White_Space; what the pattern of the tokenizer file calls \s.
_SPACE = "\\t\\n\\x0b\\x0c\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_FIELDS = regex.compile(f"[^{_SPACE}]+")
_ODD = regex.compile("[\\x1c-\\x1f]")
#: Words that are kept: of the last so many new ones and of as many before them.
_KEPT_WORDS, _KEPT_PAIRS = 75_000, 150_000
#: Characters below this one are letters or not, and have lower case, alike in all editions of Unicode.
_STABLE = "\u0250"


def _byte_units() -> list[str]:
    """The printable character that stands for each byte: itself where it is visible, else one from 256 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(spare)) for b in range(256)]


class Codec:
    """Encodes and decodes with a tokenizer file of the kind 'BPE with word ends' (lower case, white space dropped)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        vocab: dict[str, int] = model["vocab"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        pattern = next(x["pattern"]["Regex"] for x in spec["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split")
        self.pieces = regex.compile(pattern.replace("\\s", _SPACE))
        # Rare scripts: what is a letter there depends on the edition of Unicode, so the library's own tables are asked.
        self.normal = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
        self.rare = pre_tokenizers.Sequence([pre_tokenizers.Split(Regex(pattern), "removed", invert=True), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.units = _byte_units()
        self.ids = {self._inner(k): v for k, v in vocab.items()}
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        self.born = {}
        self.split = {}
        self.joined = {}
        for rank, (a, b) in enumerate(model["merges"]):
            x, y, z = vocab[a], vocab[b], vocab[a + b]
            if z not in self.born:
                self.born[z], self.split[z] = rank, (x, y)
            self.joined.setdefault((x, y), rank)
        self.last = {x: chr(ord(x) + 0x1000) for x in self.units}
        #: Of each token its length in units, and the longest token that is a proper prefix of it (-1: none).
        self.sizes, self.shorter = [0] * self.size, [-1] * self.size
        self.matcher = ahocorasick.Automaton()
        for text, i in self.ids.items():
            self.sizes[i] = len(text)
            self.shorter[i] = next((self.ids[text[:k]] for k in range(len(text) - 1, 0, -1) if text[:k] in self.ids), -1)
            self.matcher.add_word(text, (len(text) - 1, i))
        self.matcher.make_automaton()
        self.fits: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        names = [b""] * self.size
        for k, v in [*vocab.items(), *self.special.items()]:
            names[v] = k.encode() + b" "
        self.offsets = np.concatenate([[0], np.cumsum([len(x) for x in names])])
        self.names = np.frombuffer(b"".join(names), np.uint8)

    def _inner(self, token: str) -> str:
        """One character a unit: the last unit of a word is another character than the same unit within."""
        if token.endswith(self.end) and len(token) > len(self.end):
            token = token[: -len(self.end)]
            return token[:-1] + chr(ord(token[-1]) + 0x1000)
        return token

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens at one edge of a token, from itself down to a unit, each with the rank at which it goes up in the next."""
        out, until = [], _FOREVER
        while True:
            out.append((token, until))
            if token not in self.split:
                return out
            until = self.born[token]
            token = self.split[token][side]

    def compatible(self, left: int, right: int) -> bool:
        """Whether no merge joins what stands at the border while both sides are built up; of equal merges the leftmost is first."""
        known = True
        ends, starts = self._edge(left, 1), self._edge(right, 0)
        for x, x_until in ends:
            for y, y_until in starts:
                rank = self.joined.get((x, y), _FOREVER)
                if rank < x_until and rank <= y_until and rank < _FOREVER:
                    known = False
        if len(self.fits) >= _KEPT_PAIRS:
            self.fits.clear()
        self.fits[left << 20 | right] = known
        return known

    def encode_piece(self, piece: str) -> list[int]:
        if piece.isascii() and piece.isprintable():
            return self.encode_units(piece)
        units = self.units
        return self.encode_units("".join([units[x] for x in piece.encode("utf-8", "surrogatepass")]))

    def encode_units(self, text: str) -> list[int]:
        """Ids of a word of which each byte is one character."""
        text = text[:-1] + self.last[text[-1]]
        token = self.ids.get(text)
        if token is not None:
            return [token]
        n = len(text)
        longest = [0] * n
        for end, found in self.matcher.iter(text):
            longest[end - found[0]] = found[1]  # matches end later and later, so the longest of a position comes last
        token = longest[0]
        size, shorter, fits = self.sizes, self.shorter, self.fits
        alive = [True] * (n + 1)
        tokens: list[int] = []
        at = 0
        while at < n:
            while token >= 0:
                end = at + size[token]
                if alive[end]:
                    if not tokens:
                        break
                    pair = tokens[-1] << 20 | token
                    ok = fits.get(pair)
                    if ok is None:
                        ok = self.compatible(tokens[-1], token)
                    if ok:
                        break
                token = shorter[token]
            if token >= 0:
                tokens.append(token)
                at = end
                if at < n:
                    token = longest[at]
            else:
                alive[at] = False
                token = tokens.pop()
                at -= size[token]
                token = shorter[token]
        return tokens

    def _field(self, field: str) -> bytes:
        """Ids of a text without white space, as bytes."""
        if not field.isascii():
            if max(field) >= _STABLE:
                rare = array("i")
                for units, _ in self.rare.pre_tokenize_str(self.normal.normalize_str(field)):
                    rare.extend(self.encode_units(units))
                return rare.tobytes()
            field = unicodedata.normalize("NFC", field)
        field = field.lower()
        if field.isalpha() and field.isascii():
            return array("i", self.encode_piece(field)).tobytes()
        ids = array("i")
        for piece in self.pieces.findall(field):
            ids.extend(self.encode_piece(piece))
        return ids.tobytes()

    def _known(self, field: str) -> bytes:
        """Ids of a text without white space, kept for the next time. What differs in marks at its end, or in the case of ASCII
        letters, is one word and these marks, which are a piece of their own after a letter."""
        got = self.words.get(field)
        if got is not None:
            return got
        got = self.before.get(field)
        if got is None:
            word = field.rstrip(string.punctuation)
            if word and word[-1] < _STABLE and word[-1].lower().isalpha():
                tail = field[len(word) :]
                if word.isascii():
                    word = word.lower()
                got = self._known(word) + (self._known(tail) if tail else b"") if word != field else self._field(field)
            else:
                got = self._field(field)
        if len(field) <= 64:
            if len(self.words) >= _KEPT_WORDS:
                self.words, self.before = {}, self.words
            self.words[field] = got
        return got

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text; the special tokens' own strings give their ids."""
        out = []
        for part in self.cut.split(text) if self.cut and "<|" in text else (text,):
            if part in self.special:
                out.append(np.int32(self.special[part]).tobytes())
                continue
            for field in _FIELDS.findall(part) if _ODD.search(part) else part.split():
                got = self.words.get(field)
                out.append(self._known(field) if got is None else got)
        return np.frombuffer(b"".join(out), np.int32)

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens' strings, joined by one space, in UTF-8."""
        if not len(ids):
            return b""
        start = self.offsets[ids]
        size = self.offsets[ids + 1] - start
        ends = np.cumsum(size)
        where = np.repeat(start - (ends - size), size)
        where += np.arange(len(where))
        return self.names[where[:-1]].tobytes()


@lru_cache(2)
def codec(path: str) -> Codec:
    return Codec(path)


def _blocks(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about limit bytes of text each."""
    size = batch.column(column).fill_null("").cast(pa.large_string())
    offs = np.frombuffer(size.buffers()[1], np.int64)[size.offset : size.offset + len(size) + 1] if len(size) else np.zeros(1, np.int64)
    at = 0
    while at < len(batch):
        end = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, side="right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def _encode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    c = codec(path)
    for whole in batches:
        for batch in _blocks(whole, "__text", 2 << 20):
            ids = [c.encode(x or "") for x in batch.column("__text").to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*ids, np.zeros(0, np.int32)])))
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(batch.num_columns - 1)], lists], [*batch.schema.names[:-1], "ids"])


def _decoded(batch: pa.RecordBatch, c: Codec) -> pa.RecordBatch:
    """A batch whose last column has ids, with the texts that they decode to."""
    lists = batch.column(batch.num_columns - 1)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    bounds = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy())])
    texts = [c.decode(flat[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
    return pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary()).cast(pa.string())], [*batch.schema.names, "decoded"])


def _decode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    c = codec(path)
    for batch in batches:
        for at in range(0, len(batch), 64):
            yield _decoded(batch.slice(at, 64), c)


def _round_trip(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    c = codec(path)
    for batch in _encode(batches, path):
        yield _decoded(batch, c)


def _with(df: DataFrame, name: str, kind: str) -> str:
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema), f"`{name}` {kind}"])


def bpe_encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its id and ids (array of int), the tokens of its whole text. A null or empty text gives an empty
    array. Rows keep their place and number: nulls, repeated ids and repeated rows are encoded each for itself.
    Other columns are not read. No shuffle: each task maps its own rows."""
    base = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))
    return base.mapInArrow(partial(_encode, path=path), _with(base.drop("__text"), "ids", "array<int>"))


def bpe_decode(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """The rows of encoded, and decoded, the text of their ids. Null ids give an empty text."""
    base = encoded.select(*[c for c in encoded.columns if c != ids_col], ids_col)
    return base.mapInArrow(partial(_decode, path=path), _with(base, "decoded", "string"))


def bpe_round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its id, ids and decoded, as bpe_encode and bpe_decode give them, in one pass."""
    base = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))
    return base.mapInArrow(partial(_round_trip, path=path), _with(base.drop("__text"), "ids", "array<int>") + ", decoded string")
