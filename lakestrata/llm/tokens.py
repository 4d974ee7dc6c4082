"""Exact encoding of long texts in parts, for the public tokenizers.

Hard boundary: a position whose previous character is not white space and
whose next character is.  Neither tokenizer has a pre-token that runs from a
non-space into white space, their normalizers change nothing across such a
position, and their special strings hold no white space (checked at load).
Encoding the parts between hard boundaries therefore gives exactly the ids of
the whole text; the tests hold this against whole-text encoding.

Two uses:
* ``batch``: texts are cut at every hard boundary and the distinct parts looked
  up in a bounded memo, so the library encodes each frequent part once per
  worker.
* ``resync``: a huge text is encoded in overlapping chunks with offsets.  Two
  neighbours are spliced at a hard boundary inside their overlap, after the
  tokens between the first and the last such boundary were seen to be equal in
  both; if there is none, or they differ, the overlap is widened until it
  covers the chunk, which is then encoded together with its neighbour.
"""

from __future__ import annotations

import bisect
import json
import os
import re
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Unicode White_Space, the class both tokenizers' patterns call white space.
SPACE = " \t\n\r\x0b\x0c\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECES = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
HARD = re.compile(f"(?<=[^{SPACE}])(?=[{SPACE}])")
# A white-space character before a plain space: such a space starts no part of its own.
GLUED = f"[{SPACE}] "
MEMO_PARTS = 500_000    # parts remembered per worker, some 200 bytes each beside names and ids; a full memo
MEMO_BYTES = 64 << 20   # (or one whose names and ids are above this size) keeps those that were asked for again
# What may follow a space as one part that needs no look inside: for the byte-level pattern a word of
# Latin-1 letters and the ASCII signs after it (two pre-tokens), else anything without white space.
SIMPLE = r"^(?P<a>[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+)(?P<b>[!-&(-/:-@\[-`{-~]*)$"
WHOLE = f"^(?P<a>[^{SPACE}]+)(?P<b>)$"


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


def ragged(at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The positions of the slices ``at[i]:at[i] + size[i]``, one after another."""
    end = np.cumsum(size)
    where = np.repeat(at - (end - size), size)
    where += np.arange(len(where))
    return where


class Encoder:
    """One tokenizer of the ``tokenizers`` library with a bounded memo of parts.

    For the plain byte-level pre-tokenizer, words of Latin letters go to the
    library's model without running the pre-tokenizer on each of them."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.no_padding()
        self.tok.no_truncation()
        for t in self.tok.get_added_tokens_decoder().values():
            if t.lstrip or t.rstrip or t.single_word or re.search(rf"\s|[{SPACE}]", t.content):
                raise ValueError(f"special string {t.content!r} could cross a hard boundary")
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        cut = made["pre_tokenizer"] or {}
        bytewise = (cut.get("type"), cut.get("add_prefix_space"), cut.get("use_regex", True)) == ("ByteLevel", False, True)
        self.letters = byte_letters() if bytewise and not made["normalizer"] else None
        self.model = Tokenizer(self.tok.model) if self.letters else None
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}                     # part -> its number
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0  # ids of all parts
        self.at, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.asked = np.zeros(0, np.int32)                      # calls that asked for a part
        self.held = 0                                           # characters of all parts

    def trim(self) -> None:
        """Forget the parts that one call alone has asked for, most of a text's vocabulary, and the least asked for
        of the others where they fill more than half the memo."""
        names, asked, flat, at, size = list(self.number), self.asked, self.flat, self.at, self.size
        keep = np.flatnonzero(asked > 1)
        keep = keep[np.argsort(-asked[keep], kind="stable")][:MEMO_PARTS // 2]
        cost = np.cumsum(4 * size[keep] + np.fromiter((len(names[i]) for i in keep.tolist()), np.int64, len(keep)))
        keep = keep[cost <= MEMO_BYTES // 2]
        self.forget()
        self.number = {names[i]: k for k, i in enumerate(keep.tolist())}
        self.flat = flat[ragged(at[keep], size[keep])]
        self.used, self.held = len(self.flat), sum(map(len, self.number))
        # counts start anew, so that parts which are no longer met leave with the next trim
        self.size, self.asked = size[keep], np.ones(len(keep), np.int32)
        self.at = np.cumsum(self.size) - self.size

    def whole(self, text: str) -> list[int]:
        return self.tok.encode(text, add_special_tokens=False).ids

    def numbers(self, parts: list[str], simple: bool = False) -> np.ndarray:
        """Numbers of parts; unknown ones are encoded.  ``simple`` ones are single pre-tokens of Latin letters or signs."""
        number = self.number
        out = np.fromiter(map(number.get, parts, repeat(-1)), np.int64, len(parts))
        unknown = np.flatnonzero(out < 0)
        if len(unknown):
            missed = [parts[i] for i in unknown.tolist()]
            new = list(dict.fromkeys(missed))
            tok, raw = self.tok, new
            if simple and self.model:  # of ASCII, only the space has another letter
                space = self.letters[32]
                tok, raw = self.model, [p.replace(" ", space) if p.isascii() else
                                        p.encode().decode("latin-1").translate(self.letters) for p in new]
            made = []
            for i in range(0, len(raw), 4096):
                made += [e.ids for e in tok.encode_batch_fast(raw[i:i + 4096], add_special_tokens=False)]
            size = np.fromiter(map(len, made), np.int64, len(made))
            total = self.used + int(size.sum())
            if total > len(self.flat):
                self.flat = np.concatenate([self.flat, np.zeros(total, np.uint32)])
            self.flat[self.used:total] = np.fromiter(chain.from_iterable(made), np.uint32, total - self.used)
            self.at = np.concatenate([self.at, self.used + np.cumsum(size) - size])
            self.size, self.used = np.concatenate([self.size, size]), total
            self.asked = np.concatenate([self.asked, np.zeros(len(new), np.int32)])
            self.held += sum(map(len, new))
            number.update(zip(new, range(len(number), len(number) + len(new))))
            out[unknown] = np.fromiter(map(number.__getitem__, missed), np.int64, len(missed))
        self.asked[out] += 1  # once a call, however often it repeats the part
        return out

    def batch(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text (unsigned 32-bit).

        Texts are split at spaces and their words numbered by Arrow; the
        distinct words are cut into parts, and the ids gathered by number."""
        column = pa.array(texts, pa.large_string())
        glued = pc.match_substring_regex(column, GLUED)
        made = iter(self._batch(column.filter(pc.invert(glued))))
        # white space before a plain space: cut part by part
        return [self._by_parts(t) if g else next(made) for t, g in zip(texts, glued.to_pylist())]

    def _batch(self, texts: pa.Array) -> list[np.ndarray]:
        if not len(texts):
            return []
        if len(self.number) > MEMO_PARTS or self.held + 4 * self.used > MEMO_BYTES:
            self.trim()
        lists = pc.split_pattern(texts, " ")
        first = lists.offsets.to_numpy()
        words = lists.values.dictionary_encode()
        distinct = words.dictionary
        cut = pc.extract_regex(distinct, SIMPLE if self.model else WHOLE)
        odd = cut.is_null().to_numpy(zero_copy_only=False)
        both = cut.filter(pa.array(~odd))
        letters, signs = (pc.struct_field(both, k).dictionary_encode() for k in "ab")
        a = self.numbers([" " + x for x in letters.dictionary.to_pylist()], True)[letters.indices.to_numpy()]
        b = self.numbers(signs.dictionary.to_pylist(), True)[signs.indices.to_numpy()]
        heads = lists.values.take(pa.array(first[:-1])).to_pylist()
        rest = [PIECES.findall(" " + w) for w in distinct.filter(pa.array(odd)).to_pylist()] + list(map(PIECES.findall, heads))
        # every distinct word, then every first word, as a row of part numbers
        odd = np.append(odd, np.ones(len(heads), bool))
        n = np.full(len(odd), 2, np.int64)
        n[odd] = list(map(len, rest))
        start = np.cumsum(n) - n
        parts = np.zeros(int(n.sum()), np.int64)
        parts[start[~odd]], parts[start[~odd] + 1] = a, b
        parts[ragged(start[odd], n[odd])] = self.numbers([p for row in rest for p in row])
        ids = self.flat[ragged(self.at[parts], self.size[parts])]
        sums = np.append(0, np.cumsum(self.size[parts]))
        size = sums[start + n] - sums[start]
        # the texts as numbers of such rows
        row = words.indices.to_numpy().astype(np.int64)
        row[first[:-1]] = np.arange(len(distinct), len(odd))
        out = ids[ragged((np.cumsum(size) - size)[row], size[row])]
        end = np.append(0, np.cumsum(size[row]))[first]
        return [out[i:j] for i, j in zip(end[:-1].tolist(), end[1:].tolist())]

    def _by_parts(self, text: str) -> np.ndarray:
        parts = self.numbers(PIECES.findall(text))
        return self.flat[ragged(self.at[parts], self.size[parts])]

    def piece_ids(self, text: str) -> list[int]:
        return self.batch([text])[0].tolist()

    def _span(self, text: str, a: int, b: int) -> tuple[list[int], list[int], list[int]]:
        e = self.tok.encode(text[a:b], add_special_tokens=False)
        return e.ids, [a + s for s, _ in e.offsets], [a + t for _, t in e.offsets]

    def resync(self, text: str, chunk: int, overlap: int) -> list[int]:
        """Ids of ``text`` from overlapping chunks of ``chunk`` characters."""
        out, a, n = [], 0, len(text)
        end = min(n, chunk)
        left = self._span(text, a, end)
        while end < n:
            wide = overlap
            while True:
                start, stop = max(a, end - wide), min(n, end - min(wide, end - a) + chunk + wide)
                if start <= a:  # nothing aligned: encode the chunk and its neighbour as one
                    left, end = self._span(text, a, stop), stop
                    break
                marks = [m.start() for m in HARD.finditer(text, start + 1, end)]
                right = self._span(text, start, stop)
                cut = self._splice(left, right, marks)
                if cut is not None:
                    at_left, at_right, mark = cut
                    out += left[0][:at_left]
                    left, a, end = tuple(x[at_right:] for x in right), mark, stop
                    break
                wide *= 2
        return out + left[0]

    @staticmethod
    def _splice(left, right, marks):
        """Where to cut both token lists: the last hard boundary, if the tokens from the first on agree."""
        if not marks:
            return None
        first, last = marks[0], marks[-1]
        l0, r0 = (bisect.bisect_left(x[1], first) for x in (left, right))
        l1, r1 = (bisect.bisect_left(x[1], last) for x in (left, right))
        if any(x[2][k - 1] > last for x, k in ((left, l1), (right, r1)) if k):
            return None
        same = all(x[l0:l1] == y[r0:r1] for x, y in zip(left, right))
        return (l1, r1, last) if same else None


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder per tokenizer file and Python worker."""
    return Encoder(path)


def public_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)
