"""Token ids of a BPE tokenizer file with word ends (lower case, white space dropped), made fast for whole corpora.

The library spends most of its time on normalising and splitting, so frequent words are encoded once per worker.
Texts of ASCII and Latin letters are split by the file's own pattern and each distinct part is encoded by merging
bytes by rank; 0xFF, which no UTF-8 text holds, stands for the word end and merges first. Everything else (other
scripts, combining marks, special tokens, unusual white space) goes to the library itself, word by word where
white space lets it be cut. ``WordBpe`` checks at start that the file has the shape this rests on, else every
text goes to the library whole."""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from sonarloom.llm.memo import Memo

#: The splitting pattern and the normaliser of the file that the quick way holds for.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PARTS = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|'s|'t|'re|'ve|'m|'ll|'d|[^\sa-zß-öø-ÿ0-9]+")
#: A text with any other character, or with a control that Python takes for white space, isn't split here.
OTHER = re.compile("[^\t\n\r -~À-ÖØ-öø-ÿ]")
PLAIN = "^[\t\n\r -~À-ÖØ-öø-ÿ]*$"


class WordBpe:
    def __init__(self, path: str, limit: int = 200_000):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.quick = self._compile(spec)
        self.parts = Memo(self._part, limit)
        self.chunks = Memo(self._chunk, limit)
        self.words = Memo(self._word, limit // 8)

    def _compile(self, spec: dict) -> bool:
        model, norm = spec["model"], spec["normalizer"] or {}
        kinds = [n["type"] for n in norm.get("normalizers", [])]
        split = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0].get("pattern", {}).get("Regex")
        if model["type"] != "BPE" or model["end_of_word_suffix"] != "</w>" or kinds != ["NFC", "Replace", "Lowercase"] or split != SPLIT:
            return False
        import tiktoken

        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}

        def raw(piece: str) -> bytes:
            end = piece.endswith("</w>")
            return bytes(byte[c] for c in (piece[:-4] if end else piece)) + b"\xff" * end

        special = {t["id"] for t in spec["added_tokens"]}
        ids = {raw(p): i for p, i in model["vocab"].items() if i not in special}
        order = [bytes([b, 255]) for b in range(256)] + [bytes([b]) for b in range(256)]
        order += [raw(a) + raw(b) for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"])]
        ranks = {t: r for r, t in enumerate(order)}
        if len(ranks) != len(order) or any(t not in ids for t in order):
            return False
        self.merge = tiktoken.Encoding("ranks", pat_str=".", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        self.of_rank = [np.array([ids[t]], "<u4").tobytes() for t in order]
        return True

    def _chunk(self, chunk: str) -> bytes:
        return b"".join(map(self.parts.__getitem__, PARTS.findall(chunk)))

    def _part(self, part: str) -> bytes:
        of = self.of_rank
        return b"".join([of[r] for r in self.merge(part.encode() + b"\xff")])

    def _word(self, word: str) -> bytes:
        return np.array(self.library.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def ids(self, text: str) -> bytes:
        """The ids of a whole text as little-endian unsigned 32-bit numbers."""
        if self.quick and not any(s in text for s in self.special):
            if not OTHER.search(text):
                return b"".join(map(self.chunks.__getitem__, text.lower().split()))
            # White space between words is dropped by the file's pattern, and no normalisation reaches across it.
            return b"".join([self.words[w] if OTHER.search(w) else self.ids(w) for w in re.split("[ \t\n\r]+", text) if w])
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def batch(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text of an Arrow array (null: empty). Words are split and numbered by Arrow, so that
        Python sees each distinct word of the batch once; ids are then gathered by number."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        plain = pa.array(np.zeros(len(texts), bool))
        if self.quick:
            plain = pc.match_substring_regex(texts, PLAIN)
            for s in self.special:
                plain = pc.and_not(plain, pc.match_substring(texts, s))
        words = pc.ascii_split_whitespace(pc.utf8_lower(texts.filter(plain)))
        coded = words.flatten().dictionary_encode()
        known = list(map(self.chunks.__getitem__, coded.dictionary.to_numpy(zero_copy_only=False).tolist()))
        flat = np.frombuffer(b"".join(known), "<u4")
        size = np.fromiter(map(len, known), np.int64, len(known)) // 4
        first, codes = np.cumsum(size) - size, coded.indices.to_numpy()
        n = size[codes]
        ends = np.concatenate([[0], np.cumsum(n)])
        ids = flat[np.repeat(first[codes] - ends[:-1], n) + np.arange(ends[-1])]
        offsets = words.offsets.to_numpy()
        bounds = ends[offsets - offsets[0]]
        quick = iter(range(len(bounds) - 1))
        out = []
        for k, is_plain in enumerate(plain.to_pylist()):
            if is_plain:
                j = next(quick)
                out.append(ids[bounds[j] : bounds[j + 1]])
            else:
                out.append(np.frombuffer(self.ids(texts[k].as_py()), "<u4"))
        return out
