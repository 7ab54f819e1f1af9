"""Byte-level BPE as a streaming transducer with bounded lookahead.

**Encoding.** A merge list decides every token after a bounded number of further bytes. Two
continuations of the same prefix can only differ to the right of a boundary. That boundary
moves to the left when, in one of the two, the last token they share is merged with what
follows; each such move uses a later merge than the move before, since the token it merges
has to be made first. The longest chain of such moves over the merge list is the sufficient
lookahead (:meth:`MergeList.lookahead`, one pass over the list). Tokens that end that many
bytes before the end of the buffer are final and sent on; the bytes behind them start anew,
since no merge crosses a final boundary. The buffer holds one block and the lookahead, however
long a run of letters is. For the 50k list the lookahead is 320 bytes.

**Decoding.** Bytes of the tokens go through an incremental UTF-8 state machine that keeps at
most three bytes between two pushes; sequences that are no UTF-8 become U+FFFD.

Every word of the split pattern goes through the transducer; the tokens of words of a slice's length at most are remembered,
so that a frequent word goes through it once per task. Texts are split a slice at a time, with or without blanks: the
last two words of a slice may still change with what follows, so the next slice starts with them. A
word that fills a slice is sent on block by block. So neither the words nor the tokens of a text ever exist
as one list unless a caller asks for them.

Defined cases: a null or empty text has no tokens and decodes to the empty text; rows with
equal or null ids are all kept; an empty table gives an empty table; other columns are ignored.
"""

import codecs
import functools
import hashlib
import json
from collections.abc import Iterable, Iterator
from itertools import chain

import regex
from pyspark.sql import DataFrame

from shiftlode.llm.common import by_row

# Fixed value: the split pattern of byte-level BPE.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

BLOCK = 1 << 12  # bytes merged at once, besides the lookahead
SLICE = 1 << 14  # characters split at once
CACHED_WORDS = 400_000  # words whose tokens a task remembers
CACHED_LENGTH = 64  # longer words are not remembered
NONE = 1 << 60


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a vocabulary file."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    letters = {chr(byte): byte for byte in plain}
    for shift, byte in enumerate(sorted(set(range(256)) - set(plain))):
        letters[chr(256 + shift)] = byte
    return letters


class MergeList:
    """Vocabulary and merges of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model, letters = content["model"], byte_letters()
        self.bytes_of: dict[int, bytes] = {
            number: bytes(letters[x] for x in token) for token, number in model["vocab"].items()
        }
        number_of = {data: number for number, data in self.bytes_of.items()}
        self.first = [number_of[bytes([byte])] for byte in range(256)]
        self.ranks: dict[tuple[int, int], int] = {}
        self.product: list[int] = []
        made = set(self.first)
        for pair in model["merges"]:
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            left, right = (number_of[bytes(letters[x] for x in token)] for token in (left, right))
            if left not in made or right not in made:
                raise ValueError("a merge uses a token that no earlier merge has made")
            self.ranks[left, right] = len(self.product)
            self.product.append(number_of[self.bytes_of[left] + self.bytes_of[right]])
            made.add(self.product[-1])
        self.special: dict[str, int] = {}
        for token in content.get("added_tokens", ()):
            if token["lstrip"] or token["rstrip"] or token["single_word"]:
                raise ValueError("added tokens with conditions are not supported")
            self.special[token["content"]] = token["id"]
            self.bytes_of[token["id"]] = token["content"].encode()
        self.longest = max(len(data) for data in self.bytes_of.values())
        self.lookahead = self._lookahead()

    def _lookahead(self) -> int:
        """Most bytes by which a boundary can move left, see the module text.

        ``moved[t]``: the longest chain so far whose last move took token ``t`` over. The next
        move merges a token with one that starts with ``t``, so ``t`` is on its left spine.
        """
        moved: dict[int, int] = {}
        starts: dict[int, set[int]] = {}  # of a token: the left parts it was made from
        for (left, right), rank in self.ranks.items():
            spine, todo = {right}, [right]
            while todo:
                new = starts.get(todo.pop(), set()) - spine
                spine |= new
                todo.extend(new)
            chain_length = max(moved.get(token, 0) for token in spine) + len(self.bytes_of[left])
            moved[left] = max(moved.get(left, 0), chain_length)
            starts.setdefault(self.product[rank], set()).add(left)
        return max(moved.values(), default=0)

    def merged_word(self, ids: list[int]) -> list[int]:
        """The same as :meth:`merged` for short lists, one merge at a time in place."""
        rank_of, product = self.ranks.get, self.product
        found = [rank_of(pair, NONE) for pair in zip(ids, ids[1:])]
        while found:
            rank = min(found)
            if rank == NONE:
                break
            at = found.index(rank)
            ids[at : at + 2] = (product[rank],)
            del found[at]
            if at:
                found[at - 1] = rank_of((ids[at - 1], ids[at]), NONE)
            if at < len(found):
                found[at] = rank_of((ids[at], ids[at + 1]), NONE)
        return ids

    def merged(self, ids: list[int]) -> list[int]:
        """Apply the merges to a list of byte tokens, the earliest merge first."""
        ranks, product = self.ranks, self.product
        while len(ids) > 1:
            found = [ranks.get(pair, NONE) for pair in zip(ids, ids[1:])]
            rank = min(found)
            if rank == NONE:
                break
            out, at, last, token = [], 0, len(ids) - 1, product[rank]
            while at < last:
                if found[at] == rank:
                    out.append(token)
                    at += 2
                else:
                    out.append(ids[at])
                    at += 1
            if at == last:
                out.append(ids[at])
            ids = out
        return ids


class Transducer:
    """Bytes of one word in, tokens out as soon as no further byte can change them."""

    def __init__(self, merges: MergeList):
        self.merges = merges
        self.buffer = bytearray()
        self.full = BLOCK + merges.lookahead + merges.longest

    def push(self, data: bytes) -> list[int]:
        out: list[int] = []
        for start in range(0, len(data), BLOCK):
            self.buffer += data[start : start + BLOCK]
            if len(self.buffer) >= self.full:
                out += self._emit(len(self.buffer) - self.merges.lookahead)
        return out

    def finish(self) -> list[int]:
        return self._emit(len(self.buffer))

    def _emit(self, stable: int) -> list[int]:
        merges, first, sizes = self.merges, self.merges.first, self.merges.bytes_of
        ids = [first[byte] for byte in self.buffer]
        ids = merges.merged_word(ids) if len(ids) <= CACHED_LENGTH else merges.merged(ids)
        if stable == len(self.buffer):
            self.buffer.clear()
            return ids
        end = final = 0
        while final < len(ids) and end + len(sizes[ids[final]]) <= stable:
            end += len(sizes[ids[final]])
            final += 1
        del self.buffer[:end]
        return ids[:final]


class _Words(dict):
    """Tokens of short words; forgets all when full, so its memory is bounded."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, word: str) -> tuple[int, ...]:
        tokens = self.encode(word)
        if len(word) <= CACHED_LENGTH:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = tokens
        return tokens


class Encoder:
    """Whole texts to tokens."""

    def __init__(self, merges: MergeList):
        self.merges = merges
        self.split = regex.compile(SPLIT)
        self.marks = regex.compile("|".join(map(regex.escape, sorted(merges.special, key=len, reverse=True))) or "(?!)")
        self.words = _Words(self._word)
        self.transducer = Transducer(merges)

    def _word(self, word: str) -> tuple[int, ...]:
        if len(word) > BLOCK:
            return tuple(self._run(word, 0, len(word)))
        return (*self.transducer.push(word.encode("utf-8", "surrogatepass")), *self.transducer.finish())

    def _run(self, text: str, start: int, stop: int) -> Iterator[int]:
        """Tokens of a word, given by its place in the text."""
        transducer = Transducer(self.merges)
        for at in range(start, stop, BLOCK):
            yield from transducer.push(text[at : min(at + BLOCK, stop)].encode("utf-8", "surrogatepass"))
        yield from transducer.finish()

    def pieces(self, text: str) -> Iterator[list[int]]:
        """The tokens of a text in lists of bounded length."""
        start = 0
        for mark in self.marks.finditer(text):
            yield from self._plain(text, start, mark.start())
            yield [self.merges.special[mark.group()]]
            start = mark.end()
        yield from self._plain(text, start, len(text))

    def _plain(self, text: str, start: int, stop: int) -> Iterator[list[int]]:
        while start < stop:
            cut = min(start + SLICE, stop)
            words = self.split.findall(text[start:cut])
            if cut < stop:
                del words[-2:]
            if words:
                yield self._known(words)
                start += sum(map(len, words))
            else:
                cut = self.split.match(text, start, stop).end()
                yield from batched(self._run(text, start, cut))
                start = cut

    def _known(self, words: list[str]) -> list[int]:
        return list(chain.from_iterable(map(self.words.__getitem__, words)))


def batched(ids: Iterable[int]) -> Iterator[list[int]]:
    out: list[int] = []
    for number in ids:
        out.append(number)
        if len(out) == BLOCK:
            yield out
            out = []
    yield out


class Decoder:
    """Tokens in, text out; keeps an unfinished UTF-8 sequence between two pushes."""

    def __init__(self, merges: MergeList):
        self.bytes_of = merges.bytes_of
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def push(self, ids: list[int]) -> str:
        return self.state.decode(b"".join(map(self.bytes_of.__getitem__, ids)))

    def finish(self) -> str:
        return self.state.decode(b"", True)


@functools.lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder per Python worker."""
    return Encoder(MergeList(path))


def bpe_encode(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and the token ids of ``text`` as an array."""

    def step():
        pieces = encoder(path).pieces
        return lambda number, value: [(number, list(chain.from_iterable(pieces(value or ""))))]

    return by_row(df.withColumn(key, df[key].cast("long")), [key, text], step, f"{key} long, ids array<int>")


def bpe_decode(df: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key`` and the text that the token ids stand for; a null array gives the empty text."""

    def step():
        merges = encoder(path).merges

        def decode(number, tokens):
            decoder = Decoder(merges)
            parts = [decoder.push(tokens[at : at + BLOCK]) for at in range(0, len(tokens or ()), BLOCK)]
            return [(number, "".join(parts) + decoder.finish())]

        return decode

    return by_row(df.withColumn(key, df[key].cast("long")), [key, ids], step, f"{key} long, text string")


def bpe_digest(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and decode every text in one pass, keeping only digests of tokens and text."""

    def step():
        own = encoder(path)
        decimal = {number: str(number) for number in own.merges.bytes_of}

        def digest(number, value):
            count, tokens, back, decoder = 0, hashlib.sha256(), hashlib.sha256(), Decoder(own.merges)
            for ids in own.pieces(value or ""):
                if ids:
                    tokens.update(("," * (count > 0) + ",".join(map(decimal.__getitem__, ids))).encode())
                    count += len(ids)
                    back.update(decoder.push(ids).encode())
            back.update(decoder.finish().encode())
            return [(number, count, tokens.hexdigest(), back.hexdigest())]

        return digest

    schema = f"{key} long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return by_row(df.withColumn(key, df[key].cast("long")), [key, text], step, schema)
