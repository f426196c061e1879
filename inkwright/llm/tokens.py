"""Exact token ids of whole texts, fast enough for a corpus.

For a tokenizer that lower-cases, drops white space and never joins across it,
a text's ids are its words' ids one after the other, and a word's ids those of
its letter runs, digits and sign runs.  So only distinct pieces are encoded,
once per Python worker.  Other tokenizers, and words with other characters than
printable ASCII and Latin-1 letters, go to the library as they are.

``Prefixes`` counts the tokens of every prefix of a word in one pass.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from inkwright.llm import words as W

SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LETTERS = "a-zß-öø-ÿ"
PLAIN = "^[!-&(-;=-~À-ÖØ-öø-ÿ]+$"  # no apostrophe (contractions), no < (special strings)
FOUND = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


def _byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level BPE files."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Codec:
    """Encodes columns of texts with a ``tokenizers`` file, without added special tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            d = json.load(f)
        steps = [(x["type"], x.get("pattern")) for x in (d.get("normalizer") or {}).get("normalizers", [])]
        cuts = [(x["type"], x.get("pattern"), x.get("behavior"), x.get("invert")) for x in (d.get("pre_tokenizer") or {}).get("pretokenizers", [])]
        self.by_word = (
            steps == [("NFC", None), ("Replace", {"Regex": r"\s+"}), ("Lowercase", None)]
            and cuts == [("Split", {"Regex": SPLIT}, "Removed", True), ("ByteLevel", None, None, None)]
            and not d["pre_tokenizer"]["pretokenizers"][1]["add_prefix_space"]
            and not d["pre_tokenizer"]["pretokenizers"][1]["use_regex"]
            and d["model"]["type"] == "BPE"
            and not d["model"].get("dropout")
            and all(not x["normalized"] and not x["single_word"] and "<" in x["content"] for x in d["added_tokens"])
        )
        self.path, self._prefixes = path, None
        self.letters = _byte_letters()
        self.pieces = W.Memo(self._encode_pieces)
        self.odd = W.Memo(self._encode_whole, 50_000)

    @property
    def prefixes(self) -> Prefixes:
        """The table of a word's prefixes, for those operators that ask for it."""
        if self._prefixes is None:
            with open(self.path, encoding="utf-8") as f:
                d = json.load(f)
            self._prefixes = Prefixes(d["model"], [x["content"] for x in d["added_tokens"]])
        return self._prefixes

    def _encode_whole(self, found: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, np.uint32) for x in self.tokenizer.encode_batch_fast(found, add_special_tokens=False)]

    def _encode_pieces(self, found: list[str]) -> list[bytes]:
        """Each piece's ids as 32-bit numbers."""
        model, letters = self.tokenizer.model, self.letters
        return [array("I", [t.id for t in model.tokenize(p if p.isascii() else "".join([letters[b] for b in p.encode()]))]).tobytes() for p in found]

    def _of_words(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(counts, ids) of distinct words."""
        low = pc.utf8_lower(distinct)
        plain = pc.match_substring_regex(distinct, PLAIN)
        spaced = pc.if_else(plain, pc.replace_substring_regex(pc.if_else(plain, low, ""), rf"([{LETTERS}]+|[0-9])", r" \1 "), "")
        own = W.Words(spaced)
        ids = self.pieces.of(own.distinct.to_pylist())
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        counts = W.sums(size[own.index], own.starts)
        flat = take_runs(np.frombuffer(b"".join(ids), np.uint32), starts_of(size), own.index)
        if (rest := np.flatnonzero(~plain.to_numpy(zero_copy_only=False))).size:
            odd = self._odd_words(distinct.take(pa.array(rest)).to_pylist())
            parts, at = [], 0
            ends = np.cumsum(counts)
            for k, x in zip(rest.tolist(), odd, strict=True):
                parts += [flat[at : ends[k]], x]
                at = ends[k]
                counts[k] = len(x)
            flat = np.concatenate([*parts, flat[at:]])
        return counts, flat

    def _odd_words(self, found: list[str]) -> list[np.ndarray]:
        out: list = [None] * len(found)
        to_library = []
        for k, w in enumerate(found):
            if "<" not in w and re.fullmatch("[!-~À-ÖØ-öø-ÿ]+", w):
                out[k] = np.frombuffer(b"".join(self.pieces.of(FOUND.findall(w.lower()))), np.uint32)
            else:
                to_library.append(k)
        if to_library:
            long = [k for k in to_library if len(found[k]) > 200]
            short = [k for k in to_library if len(found[k]) <= 200]
            for ks, of in ((short, self.odd.of), (long, self._encode_whole)):
                for k, x in zip(ks, of([found[k] for k in ks]), strict=True):
                    out[k] = x
        return out

    def encode(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(starts, ids): the ids of text i are ids[starts[i]:starts[i + 1]]; call it with a slice of texts."""
        if not self.by_word:
            own = self._encode_whole(text.to_pylist())
            return starts_of(np.fromiter(map(len, own), np.int64, len(own))), np.concatenate([np.zeros(0, np.uint32), *own])
        found = W.Words(text)
        counts, ids = self._of_words(found.distinct)
        flat = take_runs(ids, starts_of(counts), found.index)
        return starts_of(counts[found.index])[found.starts], flat

    def counts(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(starts, tokens before each word and after the last): as ``word_counts``, for a slice of texts."""
        found = W.Words(text)
        counts, _ = self._of_words(found.distinct)
        return found.starts, starts_of(counts[found.index])


class Prefixes:
    """Token counts of all prefixes of a word, by dynamic programming over its bytes.

    A sequence of tokens is what byte-pair merges make of its bytes exactly if
    that holds for each two neighbours.  So the tokens of a prefix are those of a
    shorter prefix and one more, and which one is found by looking back no
    further than the longest token: its pair with the shorter prefix's last token
    must be what the merges make of both.  Here a piece's last token carries the
    mark of a word's end; the tokens before it don't.
    """

    def __init__(self, model: dict, special: list[str]):
        self.end = model["end_of_word_suffix"]
        self.vocabulary = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank = {pair: k for k, pair in enumerate(merges)}
        self.longest = max(len(t.removesuffix(self.end)) for t in self.vocabulary if t not in special)
        self.letters = _byte_letters()
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.fits: dict[tuple[str, str], bool] = {}

    def _symbols(self, token: str) -> list[str]:
        own = list(token.removesuffix(self.end))
        return [*own[:-1], own[-1] + self.end] if token.endswith(self.end) and token != self.end else list(token)

    def _merged(self, parts: list[str]) -> list[str]:
        while len(parts) > 1:
            rank, at = min((self.rank.get(pair, 1 << 60), k) for k, pair in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _fit(self, before: str, token: str) -> bool:
        """Whether token may follow before (none: stand first)."""
        known = self.fits.get((before, token))
        if known is None:
            if len(self.fits) > 1_000_000:
                self.fits.clear()
            own = self._symbols(token)
            known = self._merged([*self._symbols(before), *own] if before else own) == ([before, token] if before else [token])
            self.fits[before, token] = known
        return known

    def _piece(self, piece: str) -> list[int]:
        """Counts of the first 0, 1, ... bytes of a piece as pieces of their own."""
        own = "".join([self.letters[b] for b in piece.encode()])
        last, count, out = [""], [0], [0]
        known, end, fit = self.vocabulary, self.end, self._fit
        for i in range(1, len(own) + 1):
            found = closed = None
            for at in range(max(0, i - self.longest), i):
                token = own[at:i]
                if found is None and token in known and fit(last[at], token):
                    found = at, token
                if closed is None and (token := token + end) in known and fit(last[at], token):
                    closed = at
                if found and closed is not None:
                    break
            last.append(found[1])
            count.append(count[found[0]] + 1)
            out.append(count[closed] + 1)
        return out

    def _plain(self, text: str) -> list[int]:
        """Counts of the first 0, 1, ... characters of a word without special strings."""
        import regex

        low = [c.lower() for c in text]
        joined = "".join(low)
        counts, before = [0] * (len(joined) + 1), 0
        at = 0
        for m in regex.finditer(SPLIT, joined):
            start, piece = m.start(), m.group()
            counts[at : start + 1] = [before] * (start + 1 - at)
            own = self._piece(piece)
            sizes = np.cumsum([len(c.encode()) for c in piece]).tolist()
            inside = [own[k] for k in sizes]
            if piece[0] == "'" and piece[1:].isalpha():  # a contraction; what it begins with is a sign and a letter
                inside[:-1] = [inside[0], *([inside[0] + self._piece(piece[1])[-1]] if len(piece) > 2 else [])]
            counts[start + 1 : m.end() + 1] = [before + n for n in inside]
            before += inside[-1]
            at = m.end()
        counts[at:] = [before] * (len(joined) + 1 - at)
        places = np.cumsum([0, *map(len, low)])
        return [counts[k] for k in places]

    def counts(self, word: str) -> np.ndarray:
        """Counts of the first 0, 1, ... characters of a word in NFC (``normal``)."""
        parts = self.special.split(word) if self.special else [word]
        out, before = [0], 0
        for k in range(0, len(parts), 2):
            special = parts[k + 1] if k + 1 < len(parts) else ""
            own = self._plain(parts[k] + special)  # a cut special string is ordinary text
            out += [before + n for n in own[1:]]
            before += own[len(parts[k])] + bool(special)
            out[-1] = before
        return np.array(out, np.int64)


def normal(text: str) -> str:
    return unicodedata.normalize("NFC", text)


def starts_of(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate((np.zeros(1, np.int64), np.cumsum(sizes, dtype=np.int64)))


def take_runs(values: np.ndarray, starts: np.ndarray, index: np.ndarray) -> np.ndarray:
    """The runs values[starts[i]:starts[i + 1]] for each i of index, one after the other."""
    runs = pa.LargeListArray.from_arrays(pa.array(starts), pa.array(values))
    return runs.take(pa.array(index)).flatten().to_numpy()


def codec(path: str) -> Codec:
    """The worker's own codec for a file; it keeps what it has encoded until another operator's task (``words.tidy``)."""
    if path not in W.KEPT:
        W.KEPT[path] = Codec(path)
    return W.KEPT[path]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
