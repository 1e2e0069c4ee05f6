"""Token ids of whole columns of texts: every distinct part of a block is encoded once."""

from __future__ import annotations

import json
import unicodedata
from array import array
from functools import lru_cache

import numpy as np

#: A Latin letter or digit and then punctuation: two words of the tokenizer's pattern,
#: whatever follows. Only letters that composition and lower case leave one letter (no
#: dotted capital I); no apostrophe, which begins words, and no bar, which special tokens hold.
APART = r'([0-9A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}])([.,;:!?)"])'
#: Fixed value: the words of the tokenizer, as its file has them.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Parts that a task remembers; a full memory is emptied, so it stays bounded.
CACHE = 150_000


class PartTokens:
    """Ids of parts between spaces, as little-endian uint32 bytes, equal to the tokenizer's.

    A part that is letters only is one word of the tokenizer's pattern, so its model is
    asked directly; any other part goes through the whole tokenizer.
    """

    def __init__(self, tokenizer_path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(tokenizer_path)
        self.model = self.whole.model
        self._expect(json.loads(self.whole.to_str()))
        self.known: dict[str, bytes] = {}
        # byte-level alphabet: printable Latin-1 stands for itself, the rest follows from 256
        printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
        rest = iter(range(256, 512))
        self.alphabet = {b: (b if b in printable else next(rest)) for b in range(256)}

    @staticmethod
    def _expect(spec: dict) -> None:
        """Raise unless the file has the rules that the short cuts here rely on."""
        normal = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        split, level = ((spec["pre_tokenizer"] or {}).get("pretokenizers", []) + [{}, {}])[:2]
        if (
            normal != ["NFC", "Replace", "Lowercase"] or spec["normalizer"]["normalizers"][1]["pattern"] != {"Regex": r"\s+"}
            or split.get("pattern") != {"Regex": PATTERN} or not split.get("invert")
            or level.get("type") != "ByteLevel" or level.get("use_regex") or level.get("add_prefix_space")
            or spec["model"]["type"] != "BPE" or spec["model"].get("end_of_word_suffix") != "</w>"
        ):
            raise ValueError("not a word-end BPE tokenizer in lower case")

    def _new(self, part: str) -> bytes:
        word = None
        if part.isascii():
            if part.isalpha():
                word = part.lower()
        elif part.isalpha() and unicodedata.is_normalized("NFC", part):
            low = "".join(map(str.lower, part))  # by character, as the tokenizer does
            if low.isalpha():
                word = low.encode().decode("latin-1").translate(self.alphabet)
        if word is None:
            return array("I", self.whole.encode(part, add_special_tokens=False).ids).tobytes()
        return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()

    def __call__(self, parts) -> list[bytes]:
        known, out = self.known, []
        if len(known) > CACHE:
            known.clear()
        for part in parts:
            ids = known.get(part)
            if ids is None:
                ids = known[part] = self._new(part)
            out.append(ids)
        return out


@lru_cache(maxsize=2)
def part_tokens(tokenizer_path: str) -> PartTokens:
    return PartTokens(tokenizer_path)


def word_ids(texts, tokens: PartTokens) -> tuple[np.ndarray, np.ndarray]:
    """(ids per text, all ids) of an Arrow string column without nulls.

    No token of the tokenizer crosses a space, a line end or the place between a letter
    and punctuation, so a text's ids are those of its parts in order.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    texts = pc.replace_substring_regex(pc.replace_substring(texts, "\n", " "), APART, r"\1 \2")
    parts = pc.split_pattern(texts, " ")
    ends = np.asarray(parts.offsets, dtype=np.int64)
    words = parts.values.slice(int(ends[0]), int(ends[-1] - ends[0])).dictionary_encode()
    known = tokens(words.dictionary.to_numpy(zero_copy_only=False))
    sizes = np.fromiter(map(len, known), dtype=np.int64, count=len(known)) // 4
    table = pa.LargeListArray.from_arrays(np.r_[0, np.cumsum(sizes)], pa.array(np.frombuffer(b"".join(known), dtype="<u4")))
    at = np.asarray(words.indices)
    total = np.r_[0, np.cumsum(sizes[at])]
    ids = np.asarray(table.take(words.indices).flatten()) if len(at) else np.zeros(0, dtype="<u4")
    return np.diff(total[ends - ends[0]]), ids
