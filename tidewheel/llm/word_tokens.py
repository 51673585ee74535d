"""Token ids of whole texts by the tokenizers library, through a bounded cache of white-space-free pieces.

Valid for tokenizers whose tokens never span a space, tab, line feed or carriage return (word BPEs that drop
white space): a text's ids are then its pieces' ids, one after another. New pieces of many texts are encoded
together. For tokenizers of the form in ``LOWER_WORDS`` (lower case, words and runs of signs apart, a last piece
that ends each word) letters of the Latin-1 range need no normal form, so such words go to the library's BPE
behind a plain split at spaces, and the ids that end words tell where each piece ends.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np

#: Pieces that a worker keeps, about 160 bytes each; beyond that it starts afresh.
MOST_PIECES = 1_200_000
#: The normal form and the split that the short way knows.
LOWER_WORDS = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "split": {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
}
#: Lower-case letters of ASCII and Latin-1, then ASCII signs but the apostrophe.
_PLAIN = re.compile(r"([a-zß-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")


class Encoder:
    def __init__(self, path: str, dtype: str = "<u4", ordinary_specials: bool = False) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer, self.dtype = Tokenizer.from_file(path), np.dtype(dtype)
        self.tokenizer.encode_special_tokens = ordinary_specials
        self.known: dict[str, bytes] = {"": b""}
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [None]
        suffix = spec["model"].get("end_of_word_suffix")
        self.short = None
        if spec.get("normalizer") == LOWER_WORDS["normalizer"] and split[0] == LOWER_WORDS["split"] and suffix and not spec["model"].get("dropout"):
            self.short = Tokenizer.from_file(path)
            self.short.normalizer = normalizers.Sequence([])
            self.short.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            vocab = self.tokenizer.get_vocab(with_added_tokens=False)
            self.last = np.zeros(max(vocab.values()) + 1, bool)
            self.last[[i for t, i in vocab.items() if t.endswith(suffix)]] = True

    def learn(self, new: list[str]) -> list[bytes]:
        """The ids of pieces, most of them together."""
        out, at, words, ends = [b""] * len(new), [], [], []
        rest = range(len(new))
        if self.short:
            rest = []
            for k, p in enumerate(new):
                m = _PLAIN.fullmatch(p)
                if m:
                    at.append(k)
                    words.append(m[1])
                    if m[2]:
                        words.append(m[2])
                    ends.append(len(words))
                else:
                    rest.append(k)
            for lo in range(0, len(at), 1024):
                a, b = ends[lo - 1] if lo else 0, ends[min(lo + 1024, len(at)) - 1]
                ids = np.array(self.short.encode_batch_fast([" ".join(words[a:b])], add_special_tokens=False)[0].ids)
                stop = np.flatnonzero(self.last[ids]) + 1
                if len(stop) != b - a:
                    raise ValueError("a word has no last piece, or several")
                cuts = (stop[np.array(ends[lo : lo + 1024]) - a - 1] * self.dtype.itemsize).tolist()
                data = ids.astype(self.dtype).tobytes()
                for k, x, y in zip(at[lo : lo + 1024], [0, *cuts], cuts, strict=False):
                    out[k] = data[x:y]
        for lo in range(0, len(rest), 4096):
            part = rest[lo : lo + 4096]
            for k, e in zip(part, self.tokenizer.encode_batch_fast([new[k] for k in part], add_special_tokens=False), strict=True):
                out[k] = np.array(e.ids, self.dtype).tobytes()
        return out

    def _pieces(self, text: str | None) -> list[str]:
        if not text:
            return []
        if self.short:
            try:  # Latin-1 has no marks that join the letter before, so ASCII letters may be lowered first
                text = text.encode("latin-1").lower().decode("latin-1")
            except UnicodeEncodeError:
                pass
        return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian integers of ``dtype``."""
        cut = [self._pieces(t) for t in texts]
        used: set[str] = set().union(*cut)
        own = dict(zip(used, map(self.known.get, used), strict=True))  # small, so the texts' lookups stay in the CPU's caches
        new = [p for p, ids in own.items() if ids is None]
        if new:
            found = dict(zip(new, self.learn(new), strict=True))
            own.update(found)
            if len(self.known) + len(new) > MOST_PIECES:
                self.known = {"": b""}
            self.known.update(found)
        get = own.__getitem__
        return [b"".join(map(get, pieces)) for pieces in cut]


@lru_cache(maxsize=2)
def encoder(path: str, dtype: str = "<u4", ordinary_specials: bool = False) -> Encoder:
    """One encoder for each worker process."""
    return Encoder(path, dtype, ordinary_specials)
