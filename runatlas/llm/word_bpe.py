"""BPE encoding and decoding with a priority queue of merge ranks over a linked list of symbols.

The vocabulary file (path a parameter) is that of a BPE tokenizer with word ends: the text
is put in NFC and lower case, words are found by a fixed pattern, their bytes become symbols,
the last of which carries the end mark. A heap holds ``(rank, left position)`` of adjacent
pairs. A popped pair whose symbols have merged with others meanwhile is stale and skipped; a
merge unlinks the right symbol and pushes the two new pairs. Decoding looks up every id's
vocabulary string and joins the strings by one space, as the library does for a file that
names no decoder.

Encodings of the parts between white space, and of the words in them, are kept in two generations of a bounded cache;
a word that stands in several parts is merged once. Decoding starts from the ids alone.

Cases: null and empty text have no ids, and decode to the empty text. Texts of any length are
taken part by part. Repeated rows, extra columns and empty tables need no special care: one row
in, one row out.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from runatlas.llm.scratch import let_workers_import, plain_columns

CACHE_PARTS = 200_000  # per generation; an entry takes about 200 bytes

# Fixed values of the tokenizer's file format: word pattern and printable stand-ins of bytes.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")
# Letters and numbers of later Unicode versions than the tokenizer's library knows: neither to it, but ordinary signs.
LATER = """558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 10EC5-10EC7
10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF
18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF
1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F"""
# Capitals (of Unicode 16 and 17) that Python may not put in lower case yet: first, last, and where the small ones begin.
CAPITALS = ((0x1C89, 0x1C89, 0x1C8A), (0xA7CB, 0xA7CB, 0x264), (0xA7CC, 0xA7CC, 0xA7CD), (0xA7CE, 0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2, 0xA7D3),
            (0xA7D4, 0xA7D4, 0xA7D5), (0xA7DA, 0xA7DA, 0xA7DB), (0xA7DC, 0xA7DC, 0x19B), (0x10D50, 0x10D65, 0x10D70), (0x16EA0, 0x16EB8, 0x16EBB))
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
SPACE_UNLIKE_PYTHON = regex.compile("[\x1c-\x1f]")
_LATER = "".join("-".join(f"\\U{int(end, 16):08x}" for end in run.split("-")) for run in LATER.split())
WORD_KNOWN = regex.compile(
    rf"(?V1)'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}--[{_LATER}]]+|[\p{{N}}--[{_LATER}]]|(?:[^\p{{White_Space}}\p{{L}}\p{{N}}]|[{_LATER}])+"
)
SMALL = {c: chr(small + c - first) for first, last, small in CAPITALS for c in range(first, last + 1)}
SURE = "\u0250"  # all letters before this one are letters to the library too
_CAPITAL = regex.compile(f"[{''.join(map(chr, SMALL))}]")


def words_of(part: str) -> list[str]:
    """Words of the pattern; parts beyond ASCII need the longer form of it. Letters alone are one word."""
    if part.isalpha() and (part.isascii() or max(part) < SURE):
        return [part]
    return (WORD if part.isascii() else WORD_KNOWN).findall(part)


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself if printable, else the next free one from 256 on."""
    rest = iter(range(256, 512))
    printable = set(_PRINTABLE)
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


class WordBpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.ids: dict[str, int] = dict(model["vocab"])
        self.end = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in (self.ids | self.special).items()}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        #: By both ids packed into one number: the rank, shifted to leave room for a position.
        self.ranks: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, (left, right) in enumerate(pairs):
            self.ranks[self.ids[left] << 32 | self.ids[right]] = rank << 32
            self.merged.append(self.ids[left + right])
        self.text_of = {str(i): t for i, t in self.strings.items()}
        symbols = byte_symbols()
        self.inner = [self.ids.get(s) for s in symbols]
        self.final = [self.ids.get(s + self.end) for s in symbols]
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.young: dict[str, str] = {}
        self.old: dict[str, str] = {}

    def encode_word(self, word: str) -> list[int]:
        """Ids of one word of the pattern."""
        data = word.encode("utf-8")
        inner = self.inner
        symbol = [inner[b] for b in data]
        symbol[-1] = self.final[data[-1]]
        if None in symbol:
            symbol = [s for s in symbol if s is not None]
        n = len(symbol)
        rank_of = self.ranks.get
        queue = []  # rank and left position in one number
        for i in range(n - 1):
            rank = rank_of(symbol[i] << 32 | symbol[i + 1])
            if rank is not None:
                queue.append(rank | i)
        if not queue:
            return symbol
        heapq.heapify(queue)
        pop, push, merged = heapq.heappop, heapq.heappush, self.merged
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while queue:
            entry = pop(queue)
            i = entry & 0xFFFFFFFF
            left, j = symbol[i], after[i]
            if j >= n or left < 0 or rank_of(left << 32 | symbol[j]) != entry - i:
                continue  # stale: one of the two has merged since
            symbol[i], symbol[j] = left, _ = merged[entry >> 32], -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                rank = rank_of(left << 32 | symbol[k])
                if rank is not None:
                    push(queue, rank | i)
            h = before[i]
            if h >= 0:
                rank = rank_of(symbol[h] << 32 | left)
                if rank is not None:
                    push(queue, rank | h)
        return [s for s in symbol if s >= 0]

    def pieces(self, segment: str) -> list[str]:
        """What stands between white space in text without special strings, in lower case."""
        if not segment.isascii():
            segment = unicodedata.normalize("NFC", segment).replace("Σ", "σ")  # no final-sigma rule in the library
            if _CAPITAL.search(segment):
                segment = segment.translate(SMALL)
        segment = segment.lower()
        if SPACE_UNLIKE_PYTHON.search(segment):  # Python's split() parts words there, the pattern does not
            return words_of(segment)
        return segment.split()

    def parts(self, text: str) -> list[str | int]:
        """The pieces of lower-case text between white space, and the ids of special strings.

        Special strings are looked for in the text as it stands: one in other letters is ordinary text.
        """
        if "<|" not in text:
            return self.pieces(text)
        out: list[str | int] = []
        for k, segment in enumerate(self.split_special.split(text)):
            if k % 2:
                out.append(self.special[segment])
            else:
                out += self.pieces(segment)
        return out

    def encode_part(self, part: str | int) -> list[int]:
        if isinstance(part, int):
            return [part]
        return [i for word in words_of(part) for i in self.encode_word(word)]

    def encode(self, text: str | None) -> list[int]:
        return [i for part in self.parts(text or "") for i in self.encode_part(part)]

    def decode(self, ids: list[int]) -> str:
        return " ".join(self.strings[i] for i in ids if i in self.strings)

    def _kept(self, part: str, encode) -> str:
        """Decimal ids of a part or word, joined by spaces; kept for the next time."""
        found = self.young.get(part)
        if found is None:
            found = self.old.get(part)
            if found is None:
                found = encode(part)
            if len(part) <= 64:
                if len(self.young) >= CACHE_PARTS:
                    self.young, self.old = {}, self.young
                self.young[part] = found
        return found

    def _written_word(self, word: str) -> str:
        return " ".join(map(str, self.encode_word(word)))

    def _written_part(self, part: str) -> str:
        words = words_of(part)
        if len(words) == 1:
            return self._written_word(words[0])
        return " ".join(filter(None, [self._kept(word, self._written_word) for word in words]))

    def written(self, text: str | None) -> str:
        """Decimal ids joined by one space."""
        parts = self.parts(text or "")
        out = list(map(self.young.get, parts))
        if None in out:
            for at in [at for at, found in enumerate(out) if found is None]:
                part = parts[at]
                out[at] = str(part) if isinstance(part, int) else self._kept(part, self._written_part)
        return " ".join(filter(None, out))

    def read(self, written: str) -> str:
        """The decoded text of ``written`` ids."""
        return " ".join(map(self.text_of.__getitem__, written.split(" "))) if written else ""


_LOADED: dict[str, WordBpe] = {}


def tokenizer(path: str) -> WordBpe:
    """One tokenizer per worker process."""
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def encode_documents(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", keep: tuple[str, ...] = ("ids", "decoded")) -> DataFrame:
    """Per row: ``doc_id``, ``n_tokens``, digests of ids and decoded text, and the ``ids`` and ``decoded`` text as far as ``keep`` names them."""
    let_workers_import(docs.sparkSession)

    def run(batches):
        bpe = tokenizer(path)
        for batch in batches:
            texts = batch.column("text")
            for at in range(0, len(texts), 256):
                written = [bpe.written(t.as_py()) for t in texts.slice(at, 256)]
                rows = [(ids, bpe.read(ids)) for ids in written]
                out = {
                    "doc_id": batch.column("doc_id").slice(at, 256),
                    "n_tokens": pa.array([ids.count(" ") + 1 if ids else 0 for ids, _ in rows], pa.int64()),
                    "ids_sha256": pa.array([_digest(ids) for ids, _ in rows], pa.string()),
                    "decoded_sha256": pa.array([_digest(text) for _, text in rows], pa.string()),
                }
                if "ids" in keep:
                    out["ids"] = pa.array([[int(i) for i in ids.split()] for ids, _ in rows], pa.list_(pa.int32()))
                if "decoded" in keep:
                    out["decoded"] = pa.array([text for _, text in rows], pa.string())
                yield pa.RecordBatch.from_pydict(out)

    docs = plain_columns(docs, doc_id=id_column, text=text_column)
    kind = docs.schema["doc_id"].dataType.simpleString()
    kinds = {"ids": "array<int>", "decoded": "string"}
    more = "".join(f", {name} {kinds[name]}" for name in kinds if name in keep)
    return docs.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string{more}")
