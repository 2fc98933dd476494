"""Token ids of whole texts: public vocabularies, word by word through a bounded cache."""

from __future__ import annotations

import re
import sys
import types
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MAX_WORDS = 500_000  # words a Python worker keeps; beyond that it forgets them all
END = 2  # id that closes a document

PART = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[!-&(-/:-@\[-`{-~]+")  # no apostrophe: it may open a part or not
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\n", b"abcdefghijklmnopqrstuvwxyz ")
ALNUM = np.array([chr(b).isalnum() and b < 128 for b in range(256)])


def kept_by_worker(name: str, make):
    """An object that lives as long as this Python worker, which serves many tasks."""
    store = sys.modules.setdefault("_evstream_worker", types.ModuleType("_evstream_worker")).__dict__
    if name not in store:
        store[name] = make()
    return store[name]


def packed(ids) -> bytes:
    return array("I", ids).tobytes()


class Words(dict):
    """Words seen so far and their ids (little-endian unsigned 32-bit, as bytes)."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word):
        if len(self) >= MAX_WORDS:
            self.clear()
        out = self[word] = self.encode(word)
        return out


def _load(path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _byte_letters() -> str:
    """The letter that byte-level vocabularies write for each byte: printable ones stand for
    themselves, the rest follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return "".join(chr(b) if b in plain else chr(next(rest)) for b in range(256))


class ByteLevel:
    """Ids of a byte-level BPE file (``.json``) whose words carry the space before them.

    Between two visible characters, a single space or line end always starts a new word, so words
    may be looked up alone; any other text is encoded whole. ``ranks`` is the same vocabulary as a
    rank table: its encoder gives the same ids in less time, and texts with a special token's name
    go to the first one.
    """

    def __init__(self, path: str, ranks: str, pattern: str):
        import base64

        import tiktoken

        self.whole = _load(path)
        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.words = Words(lambda w: self.plain(w if w[0] == "\n" else " " + w))
        self.odd = re.compile(r"\s\s")

    def plain(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return packed(self.whole.encode(text, add_special_tokens=False).ids)
        return packed(self.fast.encode_ordinary(text))

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if text[0].isspace() or text[-1].isspace() or self.odd.search(text):
            return self.plain(text)
        head, *rest = text.replace("\n", " \n").split(" ")
        return self.plain(head) + b"".join(map(self.words.__getitem__, rest))


class LowerCase:
    """Ids of a BPE file that drops white space, lowers letters and marks the ends of words.

    Blanks and line ends always part words. In Latin-1 texts, a full stop or comma after a letter
    or digit parts them too, which saves many words: nothing the file's pattern takes together
    goes on from one to the other.
    """

    def __init__(self, path: str):
        self.whole = _load(path)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.bytes_as = dict(enumerate(_byte_letters()))
        self.words = Words(self.word)

    def word(self, word: str) -> bytes:
        if not word:
            return b""
        parts = PART.findall(word)
        if parts[:1] == [word]:
            letters = word.encode().decode("latin-1").translate(self.bytes_as)
            return packed([t.id for t in self.whole.model.tokenize(letters)])
        if sum(map(len, parts)) == len(word) and not any(s in word for s in self.special):
            return b"".join([self.words[p] for p in parts])
        return packed(self.whole.encode(word, add_special_tokens=False).ids)

    def encode(self, text: str | None) -> bytes:
        return self.encode_all(pa.array([text], pa.string()))[0]

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text. Texts are lowered and cut as one run of bytes, and each word that
        they hold is looked up once."""
        texts = texts.cast(pa.large_string()).fill_null("")
        n, (_, ends, data) = len(texts), texts.buffers()
        ends = np.frombuffer(ends, np.int64)[texts.offset:texts.offset + n + 1]
        if not n or ends[0] == ends[-1]:
            return [b""] * n
        data = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]]
        ends = ends - ends[0]
        plain = data.tobytes().translate(LOWER)
        # Letters above Latin-1 are lowered by the file alone, and a special token's name has to
        # be found as it was written: those texts are parted by blanks only.
        odd = [np.flatnonzero(data >= 0xC4)]
        odd += [[m.start() for m in re.finditer(re.escape(s.lower().encode()), plain)] for s in self.special]
        rows = np.zeros(n, bool)
        rows[np.searchsorted(ends, np.concatenate(odd).astype(np.int64), "right") - 1] = True
        if rows.any():
            rest = iter(self.encode_all(texts.filter(pa.array(~rows))))
            return [b"".join(map(self.words.__getitem__, t.as_py().replace("\n", " ").split(" "))) if o else next(rest)
                    for o, t in zip(rows.tolist(), texts, strict=True)]
        x = np.frombuffer(bytearray(plain), np.uint8)
        second = np.flatnonzero(x[:-1] == 0xC3) + 1  # of the two bytes of the letters from U+00C0 on
        large = second[(x[second] <= 0x9E) & (x[second] != 0x97)]
        x[large] += 0x20
        stops = np.flatnonzero((x[1:] == ord(".")) | (x[1:] == ord(","))) + 1
        before = x[stops - 1]
        letter = ALNUM[before]
        letter |= (x[stops - 2] == 0xC3) & (before >= 0x80) & (before != 0x97) & (before != 0xB7) & (stops > 1)
        stops = stops[letter]
        ends = ends + np.searchsorted(stops, ends)
        apart = pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(ends), pa.py_buffer(np.insert(x, stops, ord(" ")))])
        words = pc.split_pattern(apart, " ")
        names = words.values.dictionary_encode()
        own = pa.ListArray.from_arrays([0, len(names.dictionary)], names.dictionary)
        own = pc.binary_join(own, pa.scalar(" ", own.type.value_type))[0].as_py().split(" ")
        ids = pa.array(list(map(self.words.__getitem__, own)), pa.large_binary()).take(names.indices)
        at = np.frombuffer(ids.buffers()[1], np.int64)[words.offsets.to_numpy()].tolist()
        ids = ids.buffers()[2].to_pybytes()
        return [ids[i:j] for i, j in zip(at[:-1], at[1:], strict=True)]


def byte_level(path: str, ranks: str, pattern: str) -> ByteLevel:
    return kept_by_worker(f"byte:{path}", lambda: ByteLevel(path, ranks, pattern))


def lower_case(path: str) -> LowerCase:
    return kept_by_worker(f"lower:{path}", lambda: LowerCase(path))
