"""BPE as a bounded-lookahead streaming transducer, with an incremental decoder.

How far to the right a token can depend on text follows from the merge list alone. Rule i = (u, v) fires
at a place only if v stands there, and v can be lost only to an earlier rule k whose left side is v or
lies on v's right edge (the token's last part, that part's last part, and so on). So
    need(i) = max over such k of len(right side of k) + need(k),
and a token that ends `lookahead` = max_i(len(v_i) + need(i)) symbols before the end of what has been
read stays as it is whatever follows. The encoder emits tokens once they are stable and holds back the
rest: its memory is the window, however long a word gets. A word that ends within the window is encoded
in one step, and such steps are kept in a bounded table.

Text before the merges: NFC, white space runs to one space, lower case, special tokens' strings cut out,
then the pattern's pieces as byte symbols, the last with the word-end suffix. Text is read in parts that
end before white space, which neither composes with what is before nor belongs to a word.

Defined cases: null text is empty: no ids, empty text. Lone surrogates can't occur in Spark strings.
Invalid UTF-8 in decoded bytes becomes U+FFFD, one for each maximal invalid part.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Words kept with their ids; the table starts anew when full.
KEPT = 200_000
#: Code points of text read at a time.
PART = 1 << 16
#: Fixed values of the vocabulary's file: how text splits into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"


@lru_cache(1)
def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if printable Latin-1, else the next from U+0100."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, n = [""] * 256, 0
    for b in range(256):
        if b in keep:
            out[b] = chr(b)
        else:
            out[b] = chr(256 + n)
            n += 1
    return out


class Merges:
    """The merge list: ranks by pair of ids, the id made, and the lookahead."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str = ""):
        self.vocab, self.suffix = vocab, suffix
        self.rank = {}
        for i, (a, b) in enumerate(merges):
            self.rank.setdefault((vocab[a], vocab[b]), (i, vocab[a + b]))
        self.lookahead = self._lookahead(merges)

    def length(self, token: str) -> int:
        return len(token) - len(self.suffix) if self.suffix and token.endswith(self.suffix) else len(token)

    def _lookahead(self, merges: list[tuple[str, str]]) -> int:
        made: dict[str, tuple[int, str]] = {}  # token -> its first rule and right part
        for i, (a, b) in enumerate(merges):
            made.setdefault(a + b, (i, b))
        firing: dict[str, tuple[list[int], list[int]]] = {}  # left side -> ranks, running maximum of len(v) + need
        most = 1
        for i, (a, b) in enumerate(merges):
            need, part, before = 0, b, i
            while True:
                ranks, best = firing.get(part, ((), ()))
                k = bisect_left(ranks, before)
                if k:
                    need = max(need, best[k - 1])
                if part not in made:
                    break
                before, part = min(before, made[part][0]), made[part][1]
            reach = self.length(b) + need
            most = max(most, reach)
            ranks, best = firing.setdefault(a, ([], []))
            ranks.append(i)
            best.append(max(reach, best[-1] if best else 0))
        return most

    def apply(self, ids: list[int]) -> list[int]:
        """All merges on a list of symbol ids, lowest rank first, leftmost first among equals."""
        n = len(ids)
        if n < 2:
            return ids
        rank = self.rank
        if n <= 24:
            ids = list(ids)
            while len(ids) > 1:
                best, at, new = 1 << 60, -1, 0
                for i in range(len(ids) - 1):
                    r = rank.get((ids[i], ids[i + 1]))
                    if r is not None and r[0] < best:
                        best, new, at = r[0], r[1], i
                if at < 0:
                    break
                ids[at : at + 2] = [new]
            return ids
        ids, after, before = list(ids), [*range(1, n), -1], list(range(-1, n - 1))
        heap = [(r[0], i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := rank.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = rank[a, b][1], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x in (before[i], i):
                if x >= 0 and after[x] >= 0 and (r := rank.get((ids[x], ids[after[x]]))):
                    heapq.heappush(heap, (r[0], x, ids[x], ids[after[x]]))
        return [t for t in ids if t >= 0]


class Transducer:
    """Encodes one word given in pieces: feed() gives the ids that are stable, finish() the rest."""

    def __init__(self, merges: Merges, sizes: list[int], window: int = 0):
        self.m, self.sizes = merges, sizes
        self.window = max(window, 4 * merges.lookahead)
        self.held: list[int] = []

    def feed(self, symbols: list[int]) -> list[int]:
        out: list[int] = []
        for lo in range(0, len(symbols), self.window):
            self.held += symbols[lo : lo + self.window]
            if len(self.held) >= self.window:
                limit, done = len(self.held) - self.m.lookahead, 0
                for t in self.m.apply(self.held):
                    if done + self.sizes[t] > limit:
                        break
                    out.append(t)
                    done += self.sizes[t]
                self.held = self.held[done:]
        return out

    def finish(self, last: int | None = None) -> list[int]:
        """last: the id that takes the place of the last symbol at a word's end."""
        if self.held and last is not None:
            self.held[-1] = last
        out, self.held = self.m.apply(self.held), []
        return out


class Tokenizer:
    """The vocabulary file's tokenizer: text to ids in parts, ids to text in parts."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        self.merges = Merges(self.vocab, merges, self.suffix)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*self.vocab.values(), *self.special.values()]) + 1
        self.sizes, self.bytes_of = [1] * size, [b""] * size
        # a file without a decoder shows its tokens' own strings, one space between them
        plain = (spec.get("decoder") or {}).get("type") != "ByteLevel"
        self.between = b" " if plain else b""
        symbols = {s: b for b, s in enumerate(byte_symbols())}
        for t, i in [*self.vocab.items(), *self.special.items()]:
            self.sizes[i] = self.merges.length(t)
            self.bytes_of[i] = t.encode() if plain or any(c not in symbols for c in t) else bytes(symbols[c] for c in t)
        self.first = [self.vocab[s] for s in byte_symbols()]
        self.last = [self.vocab[s + self.suffix] for s in byte_symbols()]
        self.decimal = [str(i) for i in range(size)]
        self.apart = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.piece = regex.compile(PATTERN)
        self.newer: tuple | None = None
        self.kept: dict[str, tuple] = {}

    def word(self, w: str) -> tuple[int, str, bytes]:
        """How many ids a word has, the ids as text, and their bytes."""
        if w in self.special:
            ids = [self.special[w]]
        else:
            t = Transducer(self.merges, self.sizes)
            raw = w.encode()
            ids = t.feed([self.first[b] for b in raw[:-1]])
            t.held.append(self.first[raw[-1]])
            ids += t.finish(self.last[raw[-1]])
        return len(ids), " ".join([self.decimal[i] for i in ids]), self.between.join([self.bytes_of[i] for i in ids])

    def ids(self, text: str) -> list[int]:
        return [int(i) for part in self.parts(text) for w in part if (s := self.word(w)[1]) for i in s.split(" ")]

    def parts(self, text: str) -> Iterator[list[str]]:
        """The words of a text, part by part."""
        for part in cut(text):
            words = self._rare if not part.isascii() and _RARE.search(part) else self._words
            if self.apart and "<" in part and self.apart.search(part):
                yield [w for x in self.apart.split(part) for w in ([x] if x in self.special else words(x))]
            else:
                yield words(part)

    def _words(self, text: str) -> list[str]:
        return self.piece.findall(normal(text))

    def _rare(self, text: str) -> list[str]:
        """As _words, for text with characters that Unicode versions class or lower differently."""
        self.newer = self.newer or newer_characters()
        lower, piece = self.newer
        return piece.findall(normal(text).translate(lower))

    def encode_decode(self, text: str, ids_to, text_to) -> int:
        """Feeds ids (as decimal text) and decoded text to two functions; how many ids there are."""
        n, begun, state = 0, False, codecs.getincrementaldecoder("utf-8")("replace")
        kept, word, lead = self.kept, self.word, b""
        for words in self.parts(text):
            if len(kept) > KEPT:
                kept.clear()
            got = []
            for w in words:
                x = kept.get(w)
                if x is None:
                    x = word(w)
                    if len(w) <= 64:
                        kept[w] = x
                got.append(x)
            if got:
                ids_to((" " if begun else "") + " ".join([x[1] for x in got]))
                begun = True
                n += sum([x[0] for x in got])
                text_to(state.decode(lead + self.between.join([x[2] for x in got])))
                lead = self.between
        text_to(state.decode(b"", True))
        return n


def normal(part: str) -> str:
    """NFC, then lower case by character. White space only separates words, so its runs need no change."""
    if part.isascii():
        return part.lower()
    part = unicodedata.normalize("NFC", part)
    return "".join([c.lower() for c in part]) if "Σ" in part else part.lower()


def cut(text: str, size: int = PART) -> Iterator[str]:
    """Parts of `size` and on to the next white space; only a longer text without any stays whole."""
    at = 0
    while len(text) - at > size:
        m = _SPACE.search(text, at + size)
        if m is None:
            break
        yield text[at : m.start()]
        at = m.start()
    yield text[at:]


#: Anything but scripts that have been the same in all recent versions of Unicode.
_RARE = regex.compile(r"[^\x00-\u0557\u0600-\u06ff\u1e00-\u1fff\u2000-\u206f\u20a0-\u20bf\u2100-\u214f\u2190-\u2bff\u3000-\u30ff\u4e00-\u9fef\uac00-\ud7a3\uff00-\uffef\U0001f300-\U0001f64f\U0001f900-\U0001f9ff]")


def newer_characters() -> tuple[dict[int, str], regex.Pattern]:
    """A table of lower case and the pattern, for the Unicode version of the library that made the vocabulary.

    Only characters are looked up there that the standard library doesn't know or whose class the regex module may take
    from a newer version.
    """
    from tokenizers import Regex, normalizers, pre_tokenizers

    doubt = [chr(c) for c in range(0x0558, 0x110000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) == "Cn" and regex.match(r"[\p{L}\p{N}]", chr(c))]
    lower = normalizers.Lowercase()
    known = {w for w, _ in pre_tokenizers.Split(Regex(r"[\p{L}\p{N}]"), "removed", invert=True).pre_tokenize_str("".join(doubt))}
    cased = [chr(c) for c in range(0x0558, 0x110000) if not 0xD800 <= c < 0xE000 and (unicodedata.category(chr(c)) == "Cn" or 0x1C80 <= c < 0x1C90 or 0xA7A0 <= c < 0xA800)]
    table = {ord(c): low for c in cased if (low := lower.normalize_str(c)) != c.lower()}
    out = "".join(map(regex.escape, [c for c in doubt if c not in known]))
    pattern = PATTERN.replace(r"\p{L}+", rf"[\p{{L}}--[{out}]]+", 1).replace(r"|\p{N}|", rf"|[\p{{N}}--[{out}]]|").replace(r"[^\s\p{L}\p{N}]+", rf"(?:[^\s\p{{L}}\p{{N}}]|[{out}])+")
    return table, regex.compile(pattern, regex.V1)


_SPACE = regex.compile(r"[ \t\n\r]")


@lru_cache(2)
def load(path: str) -> Tokenizer:
    return Tokenizer(path)


OUT = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_digests(docs: DataFrame, path: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep, n_tokens and the digests of ids and decoded text, each computed as a stream."""
    schema = T.StructType([docs.schema[k] for k in keep] + T.StructType.fromDDL(OUT).fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = load(path)
        for batch in batches:
            n, a, b = [], [], []
            for v in batch.column(len(keep)):
                ids, said = hashlib.sha256(), hashlib.sha256()
                n.append(tok.encode_decode(v.as_py() or "", lambda s: ids.update(s.encode()), lambda s: said.update(s.encode())))  # noqa: B023
                a.append(ids.hexdigest())
                b.append(said.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(k) for k in range(len(keep))] + [pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], names=schema.names)

    return docs.select(*keep, text_col).mapInArrow(run, schema)


def encode_ids(docs: DataFrame, path: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep and ids, an array of ints."""
    schema = T.StructType([docs.schema[k] for k in keep] + [T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = load(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(k) for k in range(len(keep))] + [pa.array([tok.ids(v.as_py() or "") for v in batch.column(len(keep))], pa.list_(pa.int32()))], names=schema.names)

    return docs.select(*keep, text_col).mapInArrow(run, schema)


def decode_ids(rows: DataFrame, path: str, ids_col: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep and text, decoded id by id."""
    schema = T.StructType([rows.schema[k] for k in keep] + [T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = load(path)
        for batch in batches:
            out = []
            for v in batch.column(len(keep)):
                state = codecs.getincrementaldecoder("utf-8")("replace")
                out.append("".join([state.decode((tok.between if k else b"") + tok.bytes_of[i]) for k, i in enumerate(v.as_py() or [])]) + state.decode(b"", True))
            yield pa.RecordBatch.from_arrays([batch.column(k) for k in range(len(keep))] + [pa.array(out, pa.string())], names=schema.names)

    return rows.select(*keep, ids_col).mapInArrow(run, schema)
