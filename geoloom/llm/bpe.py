"""BPE encoding and decoding as a bounded-lookahead streaming transducer.

``Merges`` reads a public word-BPE file (ids of merged tokens ascend with the
merge list) and derives from the merge list alone

* the compatibility of two neighbouring tokens: both stay as they are when their
  symbols are encoded together (undo the merges on both sides of the boundary,
  latest first, and see whether an earlier merge would have crossed it);
* the longest token, ``reach``: a token that ends behind the read position
  begins at most ``reach`` symbols back, so only the last ``reach`` boundaries
  can still be part of the result.  That is the lookahead that suffices to decide
  which tokens are stable.

``Encoder`` reads symbol after symbol.  For each position it keeps the one last
token with which the encoding of the prefix can end.  All continuations pass
through one of the last ``reach`` positions; what their backward chains have in
common is stable, is emitted and forgotten, so memory stays constant for words
of any length.  ``Decoder`` turns ids into text as they come: tokens give bytes,
and a byte-to-text automaton gives the text, whose state is whether a token came
before and at most an unfinished UTF-8 sequence.  Two tables of bytes drive it:
the spelling of the tokens with a blank between, which is how the public library
decodes with a file that names no decoder (``decoded_sha256``), and the running
text, where a word end is a blank (``text_sha256``).  Texts are read in blocks of
about ``BLOCK`` characters, cut before white space.

Edge cases: null and empty texts give no token; texts of any length are read
whole; special tokens' strings in a text become their ids, as the public
library does; repeated rows give repeated result rows.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import unicodedata
from collections.abc import Iterator
from itertools import accumulate
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

END = "</w>"


def byte_letters() -> list[str]:
    """The printable stand-in of each byte: itself if printable, else the next letter from code point 256."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class Merges:
    """Vocabulary, merge list and pre-tokenisation of a public tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.names = {i: s for s, i in self.ids.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names.update({i: s for s, i in self.special.items()})
        self.halves: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], int] = {}
        for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            pair, made = (self.ids[a], self.ids[b]), self.ids[a + b]
            self.joined[pair], self.halves[made] = made, pair
        rank = [self.joined[self.halves[t]] for t in sorted(self.halves)]
        if rank != sorted(rank) or (self.halves and min(self.halves) <= max(set(self.ids.values()) - set(self.halves))):
            raise ValueError("token ids must ascend with the merge list")
        letters = byte_letters()
        self.plain = [self.ids[c] for c in letters]
        self.final = [self.ids[c + END] for c in letters]
        # one letter for each symbol: the byte, or the byte + 256 where a word ends with it
        self.symbols: dict[int, str] = {t: chr(b) for b, t in enumerate(self.plain)} | {t: chr(b + 256) for b, t in enumerate(self.final)}
        for t in sorted(self.halves):
            a, b = self.halves[t]
            self.symbols[t] = self.symbols[a] + self.symbols[b]
        self.reach = max(map(len, self.symbols.values()))
        #: Token by its symbols, and every proper ending of one (no token: -1).
        self.tails: dict[str, int] = {}
        for t, s in self.symbols.items():
            self.tails[s] = t
            for n in range(1, len(s)):
                self.tails.setdefault(s[n:], -1)
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.split = regex.compile(pattern)
        #: Bytes of each id: its spelling, and what it says in running text.
        size = max(self.names) + 1
        self.spellings, self.running = np.full(size, b"", object), np.full(size, b"", object)
        byte_of = {c: b for b, c in enumerate(letters)}
        for i, name in self.names.items():
            self.spellings[i] = name.encode("utf-8")
            if i in self.special.values():
                self.running[i] = self.spellings[i]
            else:
                word = name.removesuffix(END)
                self.running[i] = bytes(map(byte_of.__getitem__, word)) + b" " * (word != name)
        #: Pairs judged before.
        self.known: dict[tuple[int, int], bool] = {}

    def stay(self, left: int, right: int) -> bool:
        """Whether two tokens stay as they are when their symbols are encoded together."""
        got = self.known.get((left, right))
        if got is None:
            if len(self.known) > 400_000:
                self.known.clear()
            got = self.known[left, right] = self._untouched(left, right)
        return got

    def _untouched(self, left: int, right: int) -> bool:
        latest = len(self.names) + len(self.special) + 1
        while True:
            made = self.joined.get((left, right))
            if made is not None and made < latest:
                return False
            a, b = self.halves.get(left), self.halves.get(right)
            if a is None and b is None:
                return True
            # undo the later of the two merges; a merge at the boundary must come before it to cross
            if b is None or (a is not None and left > right):
                latest, left = left, a[1]
            else:
                latest, right = right + 1, b[0]


HEAD = 5


class Encoder:
    """Incremental encoder of one word's symbols: feed() returns tokens that no later symbol can change."""

    def __init__(self, merges: Merges):
        self.m = merges
        self.back = ""  # symbols of the window
        self.last: list[int] = []  # last token of the prefix that ends at each window position
        self.size: list[int] = []  # and its length
        self.held = False  # whether the window begins with a token that is emitted already
        #: States after beginnings of HEAD symbols, which many words share.
        self.heads: dict[str, tuple[list[int], list[int]]] = {}

    def feed(self, symbols: str) -> list[int]:
        out: list[int] = []
        step = 2 * self.m.reach
        if not self.last and len(symbols) > HEAD:
            head = symbols[:HEAD]
            known = self.heads.get(head)
            if known is None:
                self._read(head)
                if len(self.heads) >= 100_000:
                    self.heads.clear()
                self.heads[head] = (self.last.copy(), self.size.copy())
            else:
                self.back, self.last, self.size = head, known[0].copy(), known[1].copy()
            symbols = symbols[HEAD:]
        for at in range(0, len(symbols), step):
            self._read(symbols[at : at + step])
            if len(self.last) > step:
                out += self._stable()
        return out

    def _read(self, symbols: str) -> None:
        tails, known, stay, last, size = self.m.tails, self.m.known, self.m.stay, self.last, self.size
        n = len(self.back)
        self.back = back = self.back + symbols
        for n in range(n + 1, len(back) + 1):
            found = []
            for k in range(n - 1, -1, -1):
                token = tails.get(back[k:n])
                if token is None:
                    break
                if token >= 0:
                    found.append((token, k))
            while True:  # the longest token that fits behind what the prefix before it ends with
                token, k = found.pop()
                if not k:
                    break
                fits = known.get((before := last[k - 1], token))
                if fits or (fits is None and stay(before, token)):
                    break
            last.append(token)
            size.append(n - k)

    def _chain(self, end: int) -> list[int]:
        """Ends of the tokens of the prefix that ends at a window position, latest first."""
        ends = []
        while end > 0:
            ends.append(end)
            end -= self.size[end - 1]
        return ends

    def _stable(self) -> list[int]:
        n, shared = len(self.last), None
        for end in range(n, max(0, n - self.m.reach), -1):
            ends = set(self._chain(end))
            shared = ends if shared is None else shared & ends
        if not shared:
            return []
        keep = max(shared)
        chain = self._chain(keep)
        out = [self.last[e - 1] for e in reversed(chain)][self.held :]
        # the last token that is emitted stays in the window: it decides what fits behind it
        start = keep - self.size[keep - 1]
        self.back, self.last, self.held = self.back[start:], self.last[start:], True
        # no token behind it begins before its end, so chains from inside it are not followed further
        self.size = [min(k, i + 1) for i, k in enumerate(self.size[start:])]
        return out

    def finish(self) -> list[int]:
        out = [self.last[e - 1] for e in reversed(self._chain(len(self.last)))][self.held :]
        self.back, self.last, self.size, self.held = "", [], [], False
        return out


def encode_word(m: Merges, word: bytes) -> list[int]:
    """Tokens of one pre-token, by the streaming encoder; the last byte carries the word end."""
    enc = Encoder(m)
    out = enc.feed(word[:-1].decode("latin-1") + chr(word[-1] + 256))
    return out + enc.finish()


class Decoder:
    """ids → text, in any portions: feed() gives the text that the ids so far make certain, finish() what is left."""

    def __init__(self, merges: Merges, spelled: bool = False):
        self.bytes_of = merges.spellings if spelled else merges.running
        self.gap = b" " if spelled else b""
        self.utf8 = codecs.getincrementaldecoder("utf-8")("replace")
        self.begun = False

    def feed(self, ids: np.ndarray) -> str:
        if not len(ids):
            return ""
        raw = self.gap.join(self.bytes_of[ids].tolist())
        if self.begun:
            raw = self.gap + raw
        self.begun = True
        return self.utf8.decode(raw)

    def finish(self) -> str:
        self.begun = False
        left = self.utf8.decode(b"", True)
        self.utf8.reset()
        return left


#: Characters of a text that are read at once; and of a chunk without white space that is encoded in portions.
BLOCK, LONG = 1 << 20, 1 << 14
_BLANK = regex.compile(r"\s")
#: Space, as Unicode has it, is what str.split() takes but for these four controls.
_ODD = regex.compile(r"[\x1c-\x1f]")


class Codec:
    """Whole texts: normalisation, pre-tokenisation, and a bounded memory of chunks met before."""

    #: Chunks remembered in each of two generations, words likewise; and the first chunks met, mostly the common ones, that outlast a task.
    KEEP, FIRST = 300_000, 60_000

    def __init__(self, path: str):
        self.m = Merges(path)
        self.spelled, self.running = Decoder(self.m, spelled=True), Decoder(self.m)
        self.encoder = Encoder(self.m)
        self.first: dict[str, bytes] = {}
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.old_words: dict[str, bytes] = {}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.m.special)) + ")") if self.m.special else None

    def forget(self) -> None:
        """Empty the memory but for the first chunks; an idle worker then holds little more than the vocabulary."""
        for known in (self.young, self.old, self.words, self.old_words, self.m.known):
            known.clear()

    def _word(self, word: str) -> bytes:
        """ids of a pre-token as little-endian 32-bit numbers."""
        got = self.words.get(word) or self.old_words.get(word)
        if got is None:
            raw = word.encode("utf-8", "surrogatepass")
            ids = self.encoder.feed(raw[:-1].decode("latin-1") + chr(raw[-1] + 256)) + self.encoder.finish()
            got = pack(f"<{len(ids)}I", *ids)
        if len(word) <= 64:
            if len(self.words) >= self.KEEP:
                self.old_words, self.words = self.words, {}
            self.words[word] = got
        return got

    def _new(self, chunk: str) -> bytes:
        got = self.young.get(chunk)
        if got is not None:
            return got
        got = self.old.get(chunk)
        if got is None:
            parts = self.m.split.findall(chunk)
            got = self._word(parts[0]) if len(parts) == 1 else b"".join([self._word(w) for w in parts])
        if len(chunk) <= 64:
            if len(self.first) < self.FIRST:
                self.first[chunk] = got
            else:
                if len(self.young) >= self.KEEP:
                    self.old, self.young = self.young, {}
                self.young[chunk] = got
        return got

    def _long(self, chunk: str) -> Iterator[bytes]:
        """ids of a chunk of any length, a portion at a time."""
        for m in self.m.split.finditer(chunk):
            raw = m[0].encode("utf-8", "surrogatepass")
            symbols = raw[:-1].decode("latin-1") + chr(raw[-1] + 256)
            for at in range(0, len(symbols), BLOCK):
                ids = self.encoder.feed(symbols[at : at + BLOCK])
                yield pack(f"<{len(ids)}I", *ids)
            ids = self.encoder.finish()
            yield pack(f"<{len(ids)}I", *ids)

    def _plain(self, whole: str) -> Iterator[bytes]:
        at, size = 0, len(whole)
        while at < size:
            # a block ends before white space; no normalisation goes across it
            found = _BLANK.search(whole, at + BLOCK) if at + BLOCK < size else None
            end = found.start() if found else size
            text, at = whole[at:end], end
            if not text.isascii():
                text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
            text = text.lower()
            chunks = regex.split(r"\s+", text) if _ODD.search(text) else text.split()
            first, known, new = self.first.get, self.young.get, self._new
            if len(text) > LONG and max(map(len, chunks), default=0) > LONG:
                for c in chunks:
                    if len(c) > LONG:
                        yield from self._long(c)
                    else:
                        yield first(c) or new(c)
                continue
            for k in range(0, len(chunks), 65536):
                known = self.young.get
                yield b"".join([first(c) or known(c) or new(c) for c in chunks[k : k + 65536]])

    def pieces(self, text: str | None) -> Iterator[bytes]:
        """ids of the text as little-endian 32-bit numbers, in lots of bounded size."""
        text = text or ""
        if self.cut is None or "<|" not in text:
            yield from self._plain(text)
            return
        for part in self.cut.split(text):
            if part in self.m.special:
                yield pack("<I", self.m.special[part])
            else:
                yield from self._plain(part)

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(b"".join(self.pieces(text)), "<u4").tolist()

    def lists(self, texts: list[str | None]) -> pa.ListArray:
        """The ids of many texts, without a Python number for each."""
        raw = [b"".join(self.pieces(t)) for t in texts]
        ends = list(accumulate((len(r) // 4 for r in raw), initial=0))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.Array.from_buffers(pa.int32(), ends[-1], [None, pa.py_buffer(b"".join(raw))]))

    def decode(self, ids: list[int]) -> str:
        return self.spelled.feed(np.array(ids, np.int64)) + self.spelled.finish()

    def digest(self, text: str | None) -> tuple[int, str, str, str]:
        """Number of tokens, SHA-256 of the ids, of the spelled and of the running text; all streams are hashed as they come."""
        ids, n = hashlib.sha256(), 0
        texts = [(d, hashlib.sha256()) for d in (self.spelled, self.running)]
        for raw in self.pieces(text):
            ids.update(raw)
            got = np.frombuffer(raw, "<u4")
            n += len(got)
            for decoder, digest in texts:
                digest.update(decoder.feed(got).encode("utf-8"))
        for decoder, digest in texts:
            digest.update(decoder.finish().encode("utf-8"))
        return n, ids.hexdigest(), *(digest.hexdigest() for _, digest in texts)


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The codec of a file; one per worker process."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def encoded(docs: DataFrame, path: str, ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, text_sha256 of every row's whole text (and ``ids`` if asked for)."""

    def digests(b: pa.RecordBatch, c: Codec) -> pa.RecordBatch:
        got = list(zip(*map(c.digest, b.column(1).to_pylist()))) or [(), (), (), ()]
        out = [b.column(0), pa.array(got[0], pa.int64()), *(pa.array(x, pa.string()) for x in got[1:])]
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "text_sha256"]
        if ids:
            out.append(c.lists(b.column(1).to_pylist()))
            names.append("ids")
        return pa.RecordBatch.from_arrays(out, names)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        try:
            for whole in batches:
                for at in range(0, max(1, whole.num_rows), 1024):
                    yield digests(whole.slice(at, 1024), c)
        finally:
            c.forget()

    got = docs.select("doc_id", "text")
    kind = got.schema["doc_id"].dataType.simpleString()
    return got.mapInArrow(rows, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, text_sha256 string" + ", ids array<int>" * ids)
