"""SentencePiece encoding and decoding, with a batched numpy Viterbi.

Words of equal length advance together: at each end position and for each
piece length, the hashes of all words' substrings probe the sorted hashes of
the pieces, the candidates' scores are compared by vectorised maxima, and the
best one's length and id are stored as backpointers.

What is maximised depends on the model file. In a unigram model a piece's
score is its log probability. In a BPE model the piece scores are only merge
ranks, whose sums mean nothing; there the path must be the one that merging by
rank gives. That path is the only one whose neighbouring pieces all stay apart
when merged on their own, so a step is worth its length if the piece and the
one before it are such a pair and nothing otherwise, and the best path is the
merged one. Pairs are tested by undoing their merges, latest first.

Defined results: NULL text gives NULL ids, an empty text none. Characters
without a piece become byte pieces (or the unknown id, in models without
them). Decoding drops control ids, turns byte pieces back into text (broken
UTF-8 into U+FFFD) and takes off the space that encoding puts in front; NULL
ids give NULL. A text that holds the space sign U+2581 itself decodes to a
space there, as the format has it. Models with a normaliser other than the identity are refused.
"""

from __future__ import annotations

import re
from functools import cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titlecorpus.llm.common import steps, table

SPACE = "▁"
#: Odd multiplier and offset of the substring hash, arithmetic modulo 2 ** 64.
STEP, SALT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x632BE59BD9B4E019)
#: Cells (words x positions) that advance at once.
CELLS = 1 << 18
#: Words of which a task keeps the ids; beyond that it starts anew (this bounds memory, not results).
KEPT_WORDS = 500_000
WORST = -1e30
#: Longer words are cut into windows that begin so many characters apart (a multiple of many periods) and overlap by so many.
WINDOW, OVERLAP = 720, 144
#: Characters next to which words may be cut, if the pieces allow it.
MARKS = "\n\t.,;:!?#$%&*()[]{}|\"'<>=+/-_\\^~@"


def hashes(codes: np.ndarray) -> np.ndarray:
    """Prefix hashes of equally long rows of code points: row i, column j covers the first j characters."""
    h = np.zeros((codes.shape[0], codes.shape[1] + 1), np.uint64)
    for j in range(codes.shape[1]):
        h[:, j + 1] = h[:, j] * STEP + codes[:, j].astype(np.uint64) + SALT
    return h


def points(words: list[str]) -> np.ndarray:
    """Code points of equally long words, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)


class Pieces:
    """Tables of a model: sorted piece hashes, scores, and for BPE the merge that made each piece and what two pieces merge to."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.clear()
        self.text = [model.id_to_piece(i) for i in range(size)]
        self.unknown = model.unk_id()
        self.bytes = np.full(256, -1, np.int64)
        special = np.zeros(size, bool)
        for i, p in enumerate(self.text):
            special[i] = model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i)
            if model.is_byte(i):
                self.bytes[int(p[3:5], 16)] = i
        self.special = special
        self.decoded = [b"" if x else t.encode() for t, x in zip(self.text, special)]
        self.decoded[self.unknown] = " \u2047 ".encode()
        for b, i in enumerate(self.bytes):
            if i >= 0:
                self.decoded[i] = bytes([b])
        score = np.array([model.get_score(i) for i in range(size)])
        normal = [i for i in range(size) if not special[i]]
        probe = " Aäﬁ①  b "
        if model.normalize(probe) not in (probe.replace(" ", SPACE), SPACE + probe.replace(" ", SPACE)):
            raise ValueError("only models with the identity normaliser are supported")
        self.front = model.normalize("a").startswith(SPACE)
        # Merge ranks are whole numbers, one after another; log probabilities are not.
        self.bpe = bool((score[normal] == np.floor(score[normal])).all())
        self.score = score
        self.longest = max(len(self.text[i]) for i in normal)
        if self.bpe:
            self._merges(normal)
        self._boundaries(normal)
        by_length: dict[int, list[int]] = {}
        for i in normal:
            if not self.bpe or self.reachable[i]:
                by_length.setdefault(len(self.text[i]), []).append(i)
        self.keys: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.power = np.ones(self.longest + 1, np.uint64)
        for n in range(self.longest):
            self.power[n + 1] = np.uint64(int(self.power[n]) * int(STEP) % 2**64)
        for n, ids in by_length.items():
            h = hashes(points([self.text[i] for i in ids]))[:, n]
            order = np.argsort(h)
            self.keys[n] = (h[order], np.array(ids)[order])

    def _boundaries(self, normal: list[int]) -> None:
        """Patterns of places that no piece spans, next to a letter: words may be cut there, and far fewer are distinct."""
        inside = {t[k:k + 2] for t in (self.text[i] for i in normal) for k in range(len(t) - 1)}
        after = {x[1] for x in inside if x[0].isalpha()}
        before = {x[0] for x in inside if x[1].isalpha()}
        escaped = lambda free: "".join(rf"\x{{{ord(c):x}}}" for c in MARKS if c not in free)
        self.cuts = [rf"(\pL)([{c}])" for c in [escaped(after)] if c] + [rf"([{c}])(\pL)" for c in [escaped(before)] if c]

    def _merges(self, normal: list[int]) -> None:
        """rank (0 for single characters), and left and right part of the merge that makes each piece."""
        size = len(self.text)
        self.id_of = {self.text[i]: i for i in normal}
        ranks = np.unique(-self.score[normal])
        self.rank = np.zeros(size + 1, np.int64)
        self.rank[normal] = np.searchsorted(ranks, -self.score[normal]) + 1
        self.rank[[i for i in normal if len(self.text[i]) == 1]] = 0
        self.left, self.right = np.full(size + 1, -1), np.full(size + 1, -1)
        self.reachable = np.zeros(size, bool)
        for i in normal:
            parts, last = self.merge(self.text[i])
            self.reachable[i] = parts == [i]
            if last and self.reachable[i]:
                self.left[i], self.right[i] = last
        pairs = [(a * (size + 1) + b, i) for i in normal if self.reachable[i] for k in range(1, len(self.text[i]))
                 if (a := self.id_of.get(self.text[i][:k], -1)) >= 0 and (b := self.id_of.get(self.text[i][k:], -1)) >= 0]
        self.pairs, self.merged = (np.array(c) for c in zip(*sorted(pairs)))

    def merge(self, word: str) -> tuple[list[int], tuple[int, int] | None]:
        """Pieces of one word by merging pairs in order of rank, then from the left; and the last merge. For single words and tables."""
        import heapq

        parts = [self.id_of.get(c, -1) for c in word]
        text, after, before = list(word), list(range(1, len(word) + 1)), list(range(-1, len(word) - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(word) and (t := text[i] + text[j]) in self.id_of:
                heapq.heappush(heap, (-self.score[self.id_of[t]], i, t))

        for i in range(len(word) - 1):
            offer(i)
        last = None
        while heap:
            _, i, t = heapq.heappop(heap)
            j = after[i] if text[i] else len(word)
            if j >= len(word) or text[i] + text[j] != t:
                continue
            last = (parts[i], parts[j])
            text[i], parts[i], text[j] = t, self.id_of[t], ""
            after[i] = after[j]
            if after[i] < len(word):
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [p for p, t in zip(parts, text) if t], last

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging leaves pieces ``a`` and ``b`` side by side; -1 (no piece) stays apart from all."""
        size = len(self.text)
        ok = np.ones(len(a), bool)
        at = np.flatnonzero((a >= 0) & (b >= 0))
        a, b = a[at].copy(), b[at].copy()
        limit = np.full(len(a), np.iinfo(np.int64).max)
        while len(at):
            key = a * (size + 1) + b
            i = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            joins = (self.pairs[i] == key) & (self.rank[self.merged[i]] < limit)
            ok[at[joins]] = False
            # Undo the later of the two merges: a merge to the left wins a tie, so b's undone first leaves room for it.
            undo_a = self.rank[a] > self.rank[b]
            done = joins | ((self.rank[a] == 0) & (self.rank[b] == 0))
            limit = np.where(undo_a, self.rank[a], self.rank[b] + 1)
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_a, b, self.left[b])
            at, a, b, limit = at[~done], a[~done], b[~done], limit[~done]
        return ok

    def viterbi(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of equally long words in a row, and how many each has; -1 for a character without a piece."""
        codes = points(words)
        count, length = codes.shape
        h = hashes(codes)
        best = np.full((count, length + 1), WORST)
        best[:, 0] = 0
        back, last = np.zeros((count, length + 1), np.int16), np.full((count, length + 1), -2, np.int64)
        for end in range(1, length + 1):
            for n in range(1, min(end, self.longest) + 1):
                if n not in self.keys:
                    continue
                start = end - n
                part = h[:, end] - h[:, start] * self.power[n]
                keys, ids = self.keys[n]
                i = np.minimum(np.searchsorted(keys, part), len(keys) - 1)
                piece = np.where(keys[i] == part, ids[i], -1)
                take = (piece >= 0) & (best[:, start] > WORST)
                if n == 1:
                    take = best[:, start] > WORST
                at = np.flatnonzero(take)
                if not len(at):
                    continue
                p = piece[at]
                if self.bpe:
                    gain = np.where(self.apart(np.where(last[at, start] == -2, -1, last[at, start]), p), float(n), WORST)
                else:
                    gain = np.where(p >= 0, self.score[p], self.score.min() - 10)
                worth = best[at, start] + gain
                up = (worth > best[at, end]) & (gain > WORST)
                best[at[up], end], back[at[up], end], last[at[up], end] = worth[up], n, p[up]
        out, at, live = np.full((count, length), -2, np.int64), np.full(count, length), np.arange(count)
        for k in range(length - 1, -1, -1):
            out[live, k] = last[live, at[live]]
            at[live] -= back[live, at[live]]
            live = live[at[live] > 0]
            if not len(live):
                break
        return out[out > -2], (out > -2).sum(1)

    def windowed(self, word: str, step: int = WINDOW, overlap: int = OVERLAP) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a long word of a BPE model, and how many: its windows advance together and are joined at a piece that both neighbours have.

        Up to that piece all neighbours stay apart by the one window, from it on by
        the other, so the joined path is the only such one. A word whose
        windows share no piece somewhere (one letter over and over) is merged pair by pair.
        """
        starts = [*range(0, len(word) - overlap, step)]
        some = max(1, CELLS // (step + overlap))
        full = [word[s:s + step + overlap] for s in starts[:-1]]
        found = [self.viterbi(full[k:k + some]) for k in range(0, len(full), some)] + [self.viterbi([word[starts[-1]:]])]
        ids = np.split(np.concatenate([f[0] for f in found]), np.cumsum(np.concatenate([f[1] for f in found]))[:-1])
        length = np.array([1, *map(len, self.text)])  # of the ids from -1 on
        place = [s + np.cumsum(length[i + 1]) - length[i + 1] for s, i in zip(starts, ids)]
        out, first = [], 0
        for k in range(len(ids) - 1):
            _, left, right = np.intersect1d(place[k] * len(length) + ids[k] + 1, place[k + 1] * len(length) + ids[k + 1] + 1, assume_unique=True, return_indices=True)
            left, right = left[left >= first], right[left >= first]
            if not len(left):
                whole = np.array(self.merge(word)[0], np.int64)
                return whole, np.array([len(whole)])
            out.append(ids[k][first:left[-1]])
            first = right[-1]
        flat = np.concatenate([*out, ids[-1][first:]])
        return flat, np.array([len(flat)])

    def learn(self, words: list[str]) -> None:
        """Ids of new words, appended to the store; byte pieces in place of unknown characters."""
        by_length: dict[int, list[str]] = {}
        slow = []
        for w in words:
            # Pieces of several spaces share one rank, which pair tests cannot order.
            if not w or self.bpe and w.startswith(SPACE * 2):
                slow.append(w)
            else:
                by_length.setdefault(len(w), []).append(w)
        long = [w for n, same in by_length.items() if self.bpe and n > WINDOW + OVERLAP for w in same]
        names, stores, sizes = [], [self.store], [self.size]

        def add(some: list[str], ids: np.ndarray, size: np.ndarray) -> None:
            if (ids < 0).any():
                each = [x if (x >= 0).all() else self._bytes(w, x) for w, x in zip(some, np.split(ids, np.cumsum(size)[:-1]))]
                ids, size = np.concatenate(each), np.array([len(x) for x in each])
            names.extend(some)
            stores.append(ids.astype(np.int32))
            sizes.append(size)

        for w in long:
            add([w], *self.windowed(w))
        for n, same in by_length.items():
            for k in range(0, 0 if self.bpe and n > WINDOW + OVERLAP else len(same), max(1, CELLS // n)):
                some = same[k:k + max(1, CELLS // n)]
                add(some, *self.viterbi(some))
        for w in slow:
            ids = np.array(self.merge(w)[0] if w else [], np.int64)
            add([w], ids, np.array([len(ids)]))
        self.number.update(zip(names, range(len(self.number), len(self.number) + len(names))))
        self.store, self.size = np.concatenate(stores), np.concatenate(sizes).astype(np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.size)[:-1]])

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.store, self.size, self.start = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def numbers(self, words: list[str]) -> np.ndarray:
        """Places of words in the store."""
        new = [w for w in words if w not in self.number]
        if len(self.number) + len(new) > KEPT_WORDS:
            self.clear()
            new = words
        if new:
            self.learn(new)
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))

    def _bytes(self, word: str, ids: np.ndarray) -> np.ndarray:
        if self.bytes[0] < 0:
            return np.where(ids < 0, self.unknown, ids)
        made, place = [], 0
        for i in ids.tolist():
            n = 1 if i < 0 else len(self.text[i])
            made.extend([i] if i >= 0 else self.bytes[list(word[place].encode())].tolist())
            place += n
        return np.array(made, np.int64)

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (an Arrow string array without nulls) in a row, and the offsets of each text."""
        import pyarrow as pa
        import pyarrow.compute as pc

        marked = pc.replace_substring(texts, " ", SPACE)
        if self.front:
            marked = pc.if_else(pc.equal(pc.binary_length(marked), 0), "", pc.binary_join_element_wise(SPACE, marked, ""))
        # A NUL of the text is itself cut off on both sides, which no piece with it forbids; it marks the cuts.
        has_nul = pc.match_substring(marked, "\0").to_numpy(zero_copy_only=False)
        given, marked = marked, pc.if_else(pa.array(has_nul), "", marked)
        # No piece holds a space sign after another character.
        for cut in [f"([^{SPACE}])({SPACE})", *self.cuts]:
            marked = pc.replace_substring_regex(marked, cut, "\\1\0\\2")
        parts = pc.split_pattern(marked, "\0")
        known = parts.values.dictionary_encode()
        at = self.numbers(known.dictionary.to_pylist())[known.indices.to_numpy(zero_copy_only=False)]
        n = self.size[at]
        end = np.concatenate([[0], np.cumsum(n)])
        flat = self.store[np.repeat(self.start[at] - end[:-1], n) + np.arange(end[-1])]
        offsets = end[parts.offsets.to_numpy()]
        if has_nul.any():
            whole = {i: self.whole(given[i].as_py()) for i in np.flatnonzero(has_nul).tolist()}
            each = [whole[i] if i in whole else flat[offsets[i]:offsets[i + 1]] for i in range(len(texts))]
            flat, offsets = np.concatenate(each), np.concatenate([[0], np.cumsum([len(x) for x in each])])
        return flat, offsets

    def whole(self, marked: str) -> np.ndarray:
        """Ids of one marked text, cut before the first space sign of each run only."""
        parts = re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", marked)
        at = self.numbers(parts)
        return np.concatenate([self.store[self.start[i]:self.start[i] + self.size[i]] for i in at])

    def decode(self, ids: list[int]) -> str:
        text = b"".join([self.decoded[i] for i in ids]).decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if self.front and text.startswith(" ") else text

    def decode_lists(self, lists):
        """The texts of an Arrow array of lists of ids; NULL lists and lists with a NULL id give NULL."""
        import pyarrow as pa
        import pyarrow.compute as pc

        offsets = lists.offsets.to_numpy()
        ids = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
        parts = pa.ListArray.from_arrays(pa.array(offsets - offsets[0], pa.int32()), pa.array(self.decoded, pa.binary()).take(ids), mask=lists.is_null() if lists.null_count else None)
        joined = pc.binary_join(parts, b"")
        try:
            text = joined.cast(pa.string())
        except pa.ArrowInvalid:  # byte pieces that are no text
            text = pa.array([x if x is None else x.decode("utf-8", "replace") for x in joined.to_pylist()], pa.string())
        text = pc.replace_substring(text, SPACE, " ")
        return pc.if_else(pc.starts_with(text, " "), pc.utf8_slice_codeunits(text, 1), text) if self.front else text


@cache
def pieces(path: str) -> Pieces:
    return Pieces(path)


def encode_texts(df: DataFrame, path: str, text: str = "text", to: str = "ids", check: str | None = None) -> DataFrame:
    """``df`` with the ids of ``text`` in ``to`` in place of the text; ``check`` names a column that says whether they decode to it."""
    names = [c for c in df.columns if c not in (text, to, check)]

    def rows(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        model = pieces(path)
        for b in steps(batches, text):
            given = b.column(text)
            flat, offsets = model.encode(pc.fill_null(given, ""))
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat.astype(np.int32)), mask=pc.is_null(given) if given.null_count else None)
            columns = [*(b.column(c) for c in names), lists]
            if check:
                columns.append(pc.equal(model.decode_lists(lists), given))
            yield pa.RecordBatch.from_arrays(columns, [*names, to, *[check] * bool(check)])

    fields = [f"`{c}` {t}" for c, t in df.dtypes if c in names]
    return df.select(*names, text).mapInArrow(rows, ", ".join([*fields, f"`{to}` array<int>", *[f"`{check}` boolean"] * bool(check)]))


def decode_ids(df: DataFrame, path: str, ids: str = "ids", to: str = "text") -> DataFrame:
    """``df`` with the text of ``ids`` in ``to`` in place of the ids."""
    names = [c for c in df.columns if c not in (ids, to)]

    def rows(batches):
        import pyarrow as pa

        model = pieces(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), model.decode_lists(b.column(ids))], [*names, to])

    fields = [f"`{c}` {t}" for c, t in df.dtypes if c in names]
    return df.select(*names, ids).mapInArrow(rows, ", ".join([*fields, f"`{to}` string"]))


def default_model() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, ids, their number and whether they decode to the document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_texts(docs, default_model(), check="round_trip").withColumn("n_ids", F.size("ids").cast("long"))
