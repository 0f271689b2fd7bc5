"""Token ids of whole texts by the tokenizers library, with a bounded memo.

Both vocabularies used here split a text before the merges. A cut at a single
space or line break between two other characters never changes the split, and
a word of Latin letters with ASCII punctuation after it (no apostrophe) splits
into the letters and the punctuation. Texts are therefore cut into such pieces
(numpy, on the bytes); the distinct pieces of a slice that the memo lacks go to
the library in a few calls, and the ids of a text are gathered from the memo.
Other words go to the library whole, as pieces of their own. Pieces are told
apart by a 64-bit key that a second hash checks. Rows that hold a special string
of the vocabulary, or white space of another form, go to the library whole, so
that they get the ids of its plain call.
"""

from __future__ import annotations

import os

import numpy as np

from flowforge.llm.common import hash_words, lowered, row_slices, scan_words

#: First bytes of the white space characters beyond ASCII.
_WIDE = np.zeros(256, bool)
_WIDE[[0xC2, 0xE1, 0xE2, 0xE3]] = True

_PUNCT = np.zeros(256, bool)
_PUNCT[[i for i in range(33, 127) if not chr(i).isalnum() and chr(i) != "'"]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[i for i in range(128) if chr(i).isalpha()]] = True
#: Letters of two bytes up to U+00FF, by their second byte.
_AFTER_C2, _AFTER_C3 = np.zeros(256, bool), np.zeros(256, bool)
_AFTER_C2[[i for i in range(128, 192) if chr(i).isalpha()]] = True
_AFTER_C3[[i - 64 for i in range(192, 256) if chr(i).isalpha()]] = True

#: Keys of the same bytes that differ by what they are: with a space before,
#: or not split.
_LEAD, _WHOLE = np.uint64(0x5851F42D4C957F2D), np.uint64(0x2545F4914F6CDD1D)
#: Pieces that go to the library as one text.
JOINED = 1000


def _letters(data: np.ndarray) -> np.ndarray:
    """Bytes that belong to letters up to U+00FF."""
    out = _LETTER[data]
    if len(data) > 1:
        second = ((data[:-1] == 0xC2) & _AFTER_C2[data[1:]]) | ((data[:-1] == 0xC3) & _AFTER_C3[data[1:]])
        out[:-1] |= second
        out[1:] |= second
    return out


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, a place of each, and each key's number among them."""
    order = np.argsort(keys)
    keys = keys[order]
    begins = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=begins[1:])
    back = np.empty(len(keys), np.int64)
    back[order] = np.cumsum(begins) - 1
    return keys[begins], order[begins], back


class MemoEncoder:
    """``keep_spaces``: a piece begins with the space before it (byte-level
    vocabulary); else white space is dropped and letters are lower-cased.
    ``special_as_text``: special strings in a text are encoded as ordinary text
    (not the library's default, and not what ``encoder`` uses)."""

    def __init__(self, path: str, keep_spaces: bool, limit: int = 500_000, special_as_text: bool = True) -> None:
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = special_as_text
        added = self.tok.get_added_tokens_decoder().values()
        self.added = [t.content.encode().lower() for t in added if not (special_as_text and t.special)]
        self.keep_spaces, self.limit = keep_spaces, limit
        # tokens that begin a piece with a space before it, or that end a word
        size = self.tok.get_vocab_size()
        self.edge = np.zeros(size, bool)
        for token, i in self.tok.get_vocab().items():
            self.edge[i] = token.startswith("\u0120") if keep_spaces else token.endswith("</w>")
        self.line_id = self.tok.encode("\n", add_special_tokens=False).ids
        self._clear()

    def _clear(self) -> None:
        # sorted keys with their entries: those learnt lately and all others
        self.levels = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))] * 2
        self.flat = np.zeros(1 << 16, np.uint16)
        # entries 0 and 1: the end id (set per row) and a line break
        self.count, self.used = 0, 0
        self.checks, self.offs, self.lens = np.zeros(1 << 14, np.uint64), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int32)
        self.end, self.line = 0, 1
        first = np.array([0, *self.line_id], np.uint16)
        self._append(first, np.array([1, len(self.line_id)]), np.zeros(2, np.uint64))

    @staticmethod
    def _room(a: np.ndarray, size: int) -> np.ndarray:
        if size <= len(a):
            return a
        out = np.zeros(max(size, len(a) * 3 // 2), a.dtype)
        out[:len(a)] = a
        return out

    def _append(self, ids: np.ndarray, lens: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """New entries; returns their numbers."""
        a, b, to = self.count, self.count + len(lens), self.used + len(ids)
        self.flat = self._room(self.flat, to)
        self.checks, self.offs, self.lens = (self._room(x, b) for x in (self.checks, self.offs, self.lens))
        self.flat[self.used:to] = ids
        self.checks[a:b], self.lens[a:b] = checks, lens
        self.offs[a:b] = self.used + np.cumsum(lens) - lens
        self.count, self.used = b, to
        return np.arange(a, b)

    def _each(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and numbers of ids of pieces that are encoded one by one."""
        found = [e.ids for e in self.tok.encode_batch_fast(pieces, add_special_tokens=False)]
        return np.array([i for ids in found for i in ids], np.uint16), np.array([len(ids) for ids in found], np.int64)

    def _joined(self, text: np.ndarray, a: np.ndarray, b: np.ndarray, lead: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces of letters only (bytes ``a`` to ``b`` of ``text``), many
        to a text: with spaces between them, or with line breaks if no space
        belongs to them. Where they end is seen on the ids."""
        by_space = lead or not self.keep_spaces
        size = b - a + 1
        to = np.cumsum(size)
        bytes_ = text[np.minimum(np.repeat(a - (to - size), size) + np.arange(to[-1]), len(text) - 1)]
        bytes_[to - 1] = 32 if by_space else 10
        ends = [*to[JOINED - 1::JOINED].tolist()]
        ends = [0, *ends] if ends and ends[-1] == to[-1] else [0, *ends, int(to[-1])]
        texts = [bytes_[i:j].tobytes().decode() for i, j in zip(ends[:-1], ends[1:])]
        groups = [t[:-1].split(t[-1]) for t in texts]
        texts = [" " + t[:-1] if by_space else t for t in texts]
        all_ids, all_lens = [], []
        for group, e in zip(groups, self.tok.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            ids = np.array(e.ids, np.int64)
            if not by_space:
                ends = np.flatnonzero(ids == self.line_id[0])
                lens = np.diff(ends, prepend=-1) - 1
                ids = np.delete(ids, ends)
            elif self.keep_spaces:
                lens = np.diff(np.flatnonzero(self.edge[ids]), append=len(ids))
            else:
                lens = np.diff(np.flatnonzero(self.edge[ids]), prepend=-1)
            if len(lens) != len(group) or lens.sum() != len(ids) or (lens < 1).any():
                ids, lens = self._each([" " + p if lead else p for p in group])
            all_ids.append(ids.astype(np.uint16))
            all_lens.append(lens)
        return np.concatenate(all_ids), np.concatenate(all_lens)

    def _known(self, keys: np.ndarray) -> np.ndarray:
        """Entry of each key, -1 where it is new."""
        index = np.full(len(keys), -1, np.int64)
        for known, entry in self.levels:
            if len(known):
                at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                hit = known[at] == keys
                index[hit] = entry[at[hit]]
        return index

    def _learn(self, text: np.ndarray, a: np.ndarray, b: np.ndarray, lead: np.ndarray, plain: np.ndarray,
               keys: np.ndarray, check: np.ndarray) -> np.ndarray:
        """Entries of new pieces, bytes ``a`` to ``b`` of ``text`` (``plain``: of
        letters only; ``lead``: with a space before)."""
        entries = np.zeros(len(keys), np.int64)
        for kind in range(3):
            mine = np.flatnonzero(~plain if kind == 2 else plain & (lead == bool(kind)))
            if len(mine):
                ids, lens = self._each([(" " if lead[i] else "") + text[a[i]:b[i]].tobytes().decode() for i in mine.tolist()]) \
                    if kind == 2 else self._joined(text, a[mine], b[mine], bool(kind))
                entries[mine] = self._append(ids, lens, check[mine])
        few, most = self.levels
        level = self._merged(few, (keys, entries))
        self.levels = [level, most] if len(level[0]) < 1 << 17 else [
            (keys[:0], entries[:0]), self._merged(most, level)]
        return entries

    @staticmethod
    def _merged(a: tuple, b: tuple) -> tuple:
        keys, entries = np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])
        order = np.argsort(keys, kind="stable")
        return keys[order], entries[order]

    def encode(self, data: np.ndarray, offs: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows of a string column, each row followed by
        ``end_id``, and the number of ids of each row."""
        parts = [self._slice(data[offs[a]:offs[b]], offs[a:b + 1] - offs[a], end_id)
                 for a, b in row_slices(offs, 2 << 20)]
        if not parts:
            return np.zeros(0, np.uint16), np.zeros(0, np.int64)
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def _plain(self, data: np.ndarray, offs: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        texts = [data[a:b].tobytes().decode() for a, b in zip(offs[:-1], offs[1:], strict=True)]
        ids = [np.array([*e.ids, end_id], np.uint16)
               for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
        return np.concatenate(ids), np.array([len(x) for x in ids], np.int64)

    def _irregular(self, data, offs, starts, ends, first) -> np.ndarray:
        """Rows whose white space is more than single spaces and line breaks
        between words: there a cut could change the split."""
        n = len(starts)
        bad = (np.diff(first) == 0) & (np.diff(offs) > 0)
        if n:
            opens, has = np.zeros(n, bool), np.diff(first) > 0
            opens[first[:-1][has]] = True
            before = np.empty(n, np.int64)
            before[1:] = ends[:-1]
            before[first[:-1][has]] = offs[:-1][has]
            gap = data[np.maximum(starts - 1, 0)]
            wrong = np.where(opens, starts != before, (starts - before != 1) | ((gap != 32) & (gap != 10)))
            bad[np.searchsorted(first, np.flatnonzero(wrong), "right") - 1] = True
            bad[has] |= ends[first[1:][has] - 1] != offs[1:][has]
        at = np.flatnonzero(_WIDE[data])
        if len(at):
            a, b = data[at], data[np.minimum(at + 1, len(data) - 1)]
            c = data[np.minimum(at + 2, len(data) - 1)]
            space = ((a == 0xC2) & ((b == 0x85) | (b == 0xA0))) | ((a == 0xE1) & (b == 0x9A) & (c == 0x80)) \
                | ((a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))) \
                | ((a == 0xE2) & (b == 0x81) & (c == 0x9F)) | ((a == 0xE3) & (b == 0x80) & (c == 0x80))
            bad[np.searchsorted(offs, at[space], "right") - 1] = True
        return bad

    def _holds_added(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Rows with an added token of the vocabulary, in any case of letters."""
        bad, low = np.zeros(len(offs) - 1, bool), data.tobytes().lower()
        for token in self.added:
            at = low.find(token)
            while at >= 0:
                row = int(np.searchsorted(offs, at, "right")) - 1
                bad[row] = True
                at = low.find(token, int(offs[row + 1]))  # one is enough for a row
        return bad

    def _entries(self, text: np.ndarray, starts: np.ndarray, ends: np.ndarray, lead: np.ndarray) \
            -> tuple[np.ndarray | None, np.ndarray | None]:
        """Memo entries of the letters and of the punctuation of distinct words
        (-1: it has none; None: a key stands for two pieces)."""
        letters = marks = np.full(len(starts), -1, np.int64)
        if not len(starts):
            return letters, marks
        # only the bytes of these words, one after the other
        size = ends - starts
        ends = np.cumsum(size)
        text = text[np.repeat((starts - (ends - size)).astype(np.int32), size) + np.arange(ends[-1], dtype=np.int32)]
        starts = ends - size
        # where the punctuation begins, and whether all before it are letters
        places = np.where(_PUNCT[text], 0, np.arange(1, len(text) + 1, dtype=np.int32))
        core = np.maximum(np.maximum.accumulate(places)[ends - 1].astype(np.int64), starts)
        others = np.concatenate([np.zeros(1, np.int32), np.cumsum(~_letters(text), dtype=np.int32)])
        whole = others[core] > others[starts]
        core[whole] = ends[whole]
        has_core, has_tail = core > starts, ends > core
        tails = int(has_tail.sum())
        a, b = np.concatenate([starts[has_core], core[has_tail]]), np.concatenate([core[has_core], ends[has_tail]])
        spaced = np.concatenate([lead[has_core], (lead & ~has_core)[has_tail]])
        odd = np.concatenate([whole[has_core], np.zeros(tails, bool)])
        key, check = (hash_words(text, a, b, family) for family in (0, 1))
        unique, at, back = _distinct(key ^ (spaced * _LEAD) ^ (odd * _WHOLE))
        if self.count > self.limit:
            self._clear()
        index = self._known(unique)
        new = at[index < 0]
        if len(new):
            plain = ~odd[new] & (new < len(a) - tails)
            index[index < 0] = self._learn(text, a[new], b[new], spaced[new], plain, unique[index < 0], check[new])
        entry = index[back]
        if (self.checks[entry] != check).any():
            return None, None
        letters, marks = letters.copy(), marks.copy()
        letters[has_core], marks[has_tail] = entry[:len(entry) - tails], entry[len(entry) - tails:]
        return letters, marks

    def _slice(self, data: np.ndarray, offs: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        rows = len(offs) - 1
        starts, ends, first = scan_words(data, offs)
        bad = self._holds_added(data, offs)
        if self.keep_spaces:
            bad |= self._irregular(data, offs, starts, ends, first)
        if bad.any():
            cuts = np.unique(np.concatenate([[0, rows], np.flatnonzero(bad), np.flatnonzero(bad) + 1]))
            parts = [(self._plain if bad[a] else self._slice)(data[offs[a]:offs[b]], offs[a:b + 1] - offs[a], end_id)
                     for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        text = data if self.keep_spaces else lowered(data)
        n = len(starts)
        row = np.repeat(np.arange(rows), np.diff(first))
        lead, line = np.zeros(n, bool), np.zeros(n, bool)
        if self.keep_spaces and n:
            inner = np.ones(n, bool)
            inner[first[:-1][np.diff(first) > 0]] = False
            gap = data[np.maximum(starts - 1, 0)]
            lead, line = inner & (gap == 32), inner & (gap == 10)
        key, check = (hash_words(text, starts, ends, family) for family in (0, 1))
        _, at, back = _distinct(key ^ (lead * _LEAD))
        if (check[at][back] != check).any():  # two words with one 64-bit key
            return self._plain(data, offs, end_id)
        letters, marks = self._entries(text, starts[at], ends[at], lead[at])
        if letters is None:
            return self._plain(data, offs, end_id)
        letters, marks = letters[back], marks[back]
        has_core, has_tail = letters >= 0, marks >= 0
        # places in the sequence: line break, letters, punctuation of each word; the end of each row
        parts = line.astype(np.int64) + has_core + has_tail
        upto = np.cumsum(parts)
        place = upto - parts + row
        seq = np.empty((int(upto[-1]) if n else 0) + rows, np.int64)
        seq[place[line]] = self.line
        place += line
        seq[place[has_core]] = letters[has_core]
        place += has_core
        seq[place[has_tail]] = marks[has_tail]
        last = np.concatenate([[0], upto])[first[1:]] + np.arange(rows)
        seq[last] = self.end
        begin, lens = self.offs[seq], self.lens[seq].astype(np.int64)
        to = np.cumsum(lens)
        ids = self.flat[np.repeat(begin - (to - lens), lens) + np.arange(to[-1] if len(to) else 0)]
        ids[to[last] - 1] = end_id
        return ids, np.diff(to[last], prepend=0)


_ENCODERS: dict[tuple[str, bool], MemoEncoder] = {}


def encoder(path: str, keep_spaces: bool) -> MemoEncoder:
    """One encoder per worker process."""
    key = (path, keep_spaces)
    if key not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        _ENCODERS[key] = MemoEncoder(path, keep_spaces, special_as_text=False)
    return _ENCODERS[key]


def release() -> None:
    """Give up the worker's encoders: called by tasks that come after all
    tokenizing, since workers live on through other stages."""
    _ENCODERS.clear()
