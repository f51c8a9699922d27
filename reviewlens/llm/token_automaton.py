"""Byte-pair encoding and decoding by a deterministic automaton over tokens.

The automaton reads token sequences; a path spells a word, and exactly one path that spells it is
accepted: its byte-pair encoding. It starts as one state with an arc for every letter. Each merge
(u, v), in order, is a gadget: the state that arcs of u lead to is copied without its arc of v, arcs
of u lead to the copy, and every state that had an arc of u gets an arc of uv to where v led. So all
arcs of a token lead to one state, and its arcs are those of the state it was copied from, less
one: the table holds that one difference per gadget, and an arc of a merged token follows from the
arc of its left part. Looked-up arcs are remembered in a plain table. A merge whose v may no longer
follow u never happens and makes no gadget.

A word is encoded by following arcs from every place that a path has reached. Every prefix of a
word has one path, so each place is reached once and the work is linear in the word. Words new to a
task take these steps together, a long one alone. Decoding emits
the labels of the arcs, joined by one space, which is what a vocabulary without a decoder says.

The split into words is the vocabulary file's own (its normalizer and pre-tokenizer); strings of its
special tokens in a text become those tokens. Texts are cut at ASCII white space first, which no
word crosses, and a part is encoded once per task and remembered, up to a number of characters.

Null texts count as empty, which have no ids; null ids decode to null. Very long texts and words
need memory for themselves alone. Rows may repeat, a null doc_id is kept, extra columns are ignored,
an empty table gives no rows. Unknown ids are left out when decoding.
"""

from __future__ import annotations

import json
import re
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.byte_pairs import Memory
from reviewlens.llm.common import list_array, ragged

#: Characters of words and parts that a task remembers; beyond it the memory starts anew.
REMEMBERED = 8_000_000
#: Looked-up arcs that a task remembers.
ARCS = 2_000_000
#: Texts encoded at a time.
ROWS = 128
#: Words of more letters go one by one; so many others take their steps together.
LONG = 64
GROUP = 8192
_NEVER = 1 << 60
_PRINTED = re.compile("[!-~]*").fullmatch
_SPACE = re.compile(r"[^\S\n]|[\x1c-\x1f]")


class Automaton:
    """The state that arcs of a token lead to is named by the token. Its copies, one per gadget that
    had the token on the left, are told apart by the gadgets' numbers alone."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str = ""):
        self.suffix = suffix
        whole = {left + right for left, right in merges}
        # Letters, which no merge makes: born before all merges, with themselves as their spelling.
        self.letters = {token: at for token, at in vocab.items() if token not in whole}
        self.size = size = max(vocab.values()) + 1
        self.born, self.left, self.right = [-1] * size, [-1] * size, [-1] * size
        self.gadgets: dict[int, int] = {}
        spelling: dict[int, tuple[int, ...]] = {at: (at,) for at in self.letters.values()}
        never: set[int] = set()
        for number, (left, right) in enumerate(merges):
            u, v, uv = vocab[left], vocab[right], vocab[left + right]
            if not {u, v} <= spelling.keys() | never or uv in spelling or uv in never:
                raise ValueError(f"merge {number} does not make a new token of two earlier ones")
            if u in never or v in never or not self.has_arc(u, v):
                never.add(uv)
                continue
            spelling[uv] = spelling[u] + spelling[v]
            self.born[uv], self.left[uv], self.right[uv] = len(self.gadgets), u, v
            self.gadgets[u * size + v] = len(self.gadgets)
        # Tokens by their letters: from a place in a word, the arcs that its letters can spell.
        self.child: dict[int, int] = {}
        self.ends = [-1]
        for token, letters in spelling.items():
            node = 0
            for letter in letters:
                step = node * size + letter
                node = self.child.get(step) or self.child.setdefault(step, len(self.ends))
                if node == len(self.ends):
                    self.ends.append(-1)
            self.ends[node] = token
        steps = np.array(sorted(self.child), np.int64)
        self.steps = np.append(steps, _NEVER)
        self.nodes = np.array([self.child[step] for step in steps.tolist()] + [-1], np.int64)
        self.tokens = np.array(self.ends, np.int64)
        self._forget()

    def _forget(self) -> None:
        """Looked-up arcs, as sorted numbers that a last one ends: most of them, and the latest."""
        self.arcs = [(np.array([_NEVER]), np.array([False])) for _ in range(2)]

    def has_arc(self, last: int, token: int) -> bool:
        """Whether the state after ``last`` has an arc of the token.

        That state is a copy of its right part's state from when ``last`` was born, and so on; each
        copy lacks the arc its gadget took away. A gadget counts where it came before the left token
        was joined, and not after the right one was.
        """
        until = _NEVER
        while last >= 0:
            joined, part = _NEVER, token
            while part >= 0:
                gadget = self.gadgets.get(last * self.size + part)
                if gadget is not None and gadget < until and gadget <= joined:
                    return False
                joined, part = self.born[part], self.left[part]
            until, last = self.born[last], self.right[last]
        return True

    def spell(self, word: str) -> list[int]:
        """Letters of a word; the last one carries the suffix. Letters without a token are left out."""
        found = [self.letters.get(letter, -1) for letter in word[:-1]]
        found += [self.letters.get(letter + self.suffix, -1) for letter in word[-1:]]
        return [letter for letter in found if letter >= 0] if -1 in found else found

    def arcs_of(self, last: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """:meth:`has_arc` of every pair, remembered; the first token of a word (-1) always has one."""
        wanted = last * self.size + tokens
        allowed = last < 0
        left = np.flatnonzero(~allowed)
        for arcs, known in self.arcs:
            at = np.searchsorted(arcs, wanted[left])
            found = arcs[at] == wanted[left]
            allowed[left[found]] = known[at[found]]
            left = left[~found]
        if len(left):
            new, place = np.unique(wanted[left], return_inverse=True)
            known = np.array([self.has_arc(*divmod(arc, self.size)) for arc in new.tolist()])
            allowed[left] = known[place]
            self._remember(new, known)
        return allowed

    def _remember(self, new: np.ndarray, known: np.ndarray) -> None:
        def joined(one, two):
            place = np.searchsorted(one[0], two[0])
            return np.insert(one[0], place, two[0]), np.insert(one[1], place, two[1])

        most, latest = self.arcs
        latest = joined(latest, (new, known))
        if len(latest[0]) > 8192:
            if len(most[0]) > ARCS:
                self._forget()
                most = self.arcs[0]
            most, latest = joined(most, (latest[0][:-1], latest[1][:-1])), (np.array([_NEVER]), np.array([False]))
        self.arcs = [most, latest]

    def path(self, letters: list[int]) -> list[int]:
        """Tokens of the one accepted path that spells the letters of a long word."""
        n, size, child, ends = len(letters), self.size, self.child.get, self.ends
        known: dict[int, bool] = {}
        reached, length = [-1] * (n + 1), [0] * (n + 1)
        for place in range(n):
            last, node = reached[place], 0
            for stop in range(place, n):
                node = child(node * size + letters[stop])
                if node is None:
                    break
                token = ends[node]
                if token < 0 or reached[stop + 1] >= 0:
                    continue
                arc = last * size + token
                if arc not in known:
                    known[arc] = self.has_arc(last, token)
                if known[arc]:
                    reached[stop + 1], length[stop + 1] = token, stop + 1 - place
        found = []
        while n:
            found.append(reached[n])
            n -= length[n]
        return found[::-1]

    def paths(self, words: list[str]) -> list[np.ndarray]:
        """Tokens of every word; words of similar length take each step together."""
        spelled = [self.spell(word) for word in words]
        sizes = np.array([len(letters) for letters in spelled], np.int64)
        found: list[np.ndarray] = [np.zeros(0, np.int32)] * len(words)
        for i in np.flatnonzero(sizes > LONG).tolist():
            found[i] = np.array(self.path(spelled[i]), np.int32)
        width = 1
        while width <= LONG:
            members = np.flatnonzero((sizes > width // 2) & (sizes <= width)).tolist()
            for first in range(0, len(members), GROUP):
                some = members[first : first + GROUP]
                for i, tokens in zip(some, self._group([spelled[i] for i in some], sizes[some], width)):
                    found[i] = tokens
            width *= 2
        return found

    def _group(self, spelled: list[list[int]], sizes: np.ndarray, width: int) -> list[np.ndarray]:
        n = len(spelled)
        letters = np.full((n, width), -1, np.int64)
        letters[np.arange(width) < sizes[:, None]] = np.fromiter(chain.from_iterable(spelled), np.int64)
        reached, length = np.full((n, width + 1), -1, np.int64), np.zeros((n, width + 1), np.int64)
        for place in range(width):
            row = np.flatnonzero(sizes > place)
            last = reached[row, place]
            node = np.zeros(len(row), np.int64)
            for stop in range(place, width):
                letter = letters[row, stop]
                step = np.where(letter < 0, -1, node * self.size + letter)
                at = np.searchsorted(self.steps, step)
                on = self.steps[at] == step
                if not on.any():
                    break
                row, last, node = row[on], last[on], self.nodes[at[on]]
                token = self.tokens[node]
                open_ = np.flatnonzero((token >= 0) & (reached[row, stop + 1] < 0))
                open_ = open_[self.arcs_of(last[open_], token[open_])]
                reached[row[open_], stop + 1] = token[open_]
                length[row[open_], stop + 1] = stop + 1 - place
        place, back = sizes.copy(), []
        while place.any():
            back.append(np.where(place > 0, reached[np.arange(n), place], -1))
            place -= length[np.arange(n), place]
        tokens = np.stack(back[::-1], axis=1)
        kept = tokens >= 0
        return np.split(tokens[kept].astype(np.int32), np.cumsum(kept.sum(axis=1))[:-1])


class Vocabulary:
    """A tokenizer file: its automaton, its split into words, the labels of its ids."""

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        parts = json.loads(definition)
        model = parts["model"]
        odd = [name for name in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges") if model.get(name)]
        if model["type"] != "BPE" or odd or parts.get("post_processor") or parts.get("decoder"):
            raise ValueError(f"no plain byte-pair vocabulary: {model['type']} {odd}")
        merges = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], merges, model.get("end_of_word_suffix") or "")
        self.special = {}
        for token in parts.get("added_tokens") or []:
            if token["normalized"] or token["single_word"] or token["lstrip"] or token["rstrip"] or re.search(r"\s", token["content"]):
                raise ValueError(f"token {token['content']!r} is not matched as it stands")
            self.special[token["content"]] = token["id"]
        longest = sorted(self.special, key=len, reverse=True)
        self._cut = re.compile("(" + "|".join(map(re.escape, longest)) + ")").split if longest else lambda part: [part]
        self.labels = {at: token for token, at in model["vocab"].items()} | {at: token for token, at in self.special.items()}
        tokenizer = Tokenizer.from_str(definition)
        self._normal, self._words = tokenizer.normalizer, tokenizer.pre_tokenizer
        # What splits ASCII text, where the file says so: the matches of one pattern, bytes shown as they are.
        steps = (parts.get("pre_tokenizer") or {}).get("pretokenizers") or []
        plain = [step["type"] for step in steps] == ["Split", "ByteLevel"] and steps[0]["behavior"] == "Removed" and steps[0]["invert"]
        plain = plain and "Regex" in steps[0]["pattern"] and not steps[1]["add_prefix_space"] and not steps[1]["use_regex"]
        self._pattern = regex.compile(steps[0]["pattern"]["Regex"]) if plain else None
        if self.split("It's\none 12") != [word for part in ("It's", "one", "12") for word in self.split(part)]:
            raise ValueError("words of the vocabulary cross white space")
        self._forget()

    def _forget(self) -> None:
        self.parts, self.words, self.remembered = Memory(), Memory(), 0

    def split(self, part: str) -> list:
        """Words of a part without ASCII white space; a special token comes as a one-tuple."""
        found: list = []
        for piece in self._cut(part):
            if piece in self.special:
                found.append((piece,))
            elif piece:
                piece = self._normal.normalize_str(piece) if self._normal else piece
                found += [word for word, _ in self._words.pre_tokenize_str(piece)] if self._words else [piece]
        return found

    def split_all(self, parts: list[str]) -> list[list]:
        """Words of every part; those without special tokens and other white space go together."""
        found: list[list] = [[]] * len(parts)
        whole = "\n".join(parts)
        special = any(token in whole for token in self.special)
        printed, other = [], []
        for i, part in enumerate(parts):
            if special and any(token in part for token in self.special) or _SPACE.search(part):
                found[i] = self.split(part)
            else:
                (printed if self._pattern and _PRINTED(part) else other).append(i)
        for some in (printed, other):
            joined = "\n".join([parts[i] for i in some])
            shown = (self._normal.normalize_str(joined) if self._normal else joined.replace("\n", " ")).split(" ")
            if len(shown) != len(some):
                words = [self.split(parts[i]) for i in some]
            elif some is printed:
                words = map(self._pattern.findall, shown)
            else:
                words = [[word for word, _ in self._words.pre_tokenize_str(part)] if self._words else [part] for part in shown]
            for i, own in zip(some, words):
                found[i] = own
        return found

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, text after text, and how many each text has."""
        if self.remembered > REMEMBERED:
            self._forget()
        lists = []
        for text in texts:
            for space in "\n\t\r\f\v":
                if space in text:
                    text = text.replace(space, " ")
            lists.append(text.split(" "))
        places = self.parts.places(lists)
        if self.parts.new:
            found = self.split_all(self.parts.new)
            self.remembered += sum(map(len, self.parts.new))
            inner = self.words.places(found)
            if self.words.new:
                self.remembered += sum(map(len, self.words.new))
                paths = self.automaton.paths(["" if isinstance(word, tuple) else word for word in self.words.new])
                for i, word in enumerate(self.words.new):
                    if isinstance(word, tuple):
                        paths[i] = np.array([self.special[word[0]]], np.int32)
                self.words.add(np.concatenate(paths), np.array(list(map(len, paths))))
            self.parts.add(*self.words.at(inner, found))
        return self.parts.at(places, lists)


@cache
def _vocabulary(definition: str) -> Vocabulary:
    """A Python worker that runs several tasks compiles once."""
    return Vocabulary(definition)


def _definition(docs: DataFrame, vocabulary: str | None):
    import public_tokenizers

    with open(vocabulary or public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id and ``ids`` (array of int) of every text."""
    definition = _definition(docs, vocabulary)

    def run(stream):
        known = _vocabulary(definition.value)
        for batch in stream:
            for first in range(0, batch.num_rows, ROWS):
                some = batch.slice(first, ROWS)
                ids, lengths = known.encode([text or "" for text in some["text"].to_pylist()])
                yield pa.RecordBatch.from_arrays([some["doc_id"], list_array(ids, lengths, pa.int32())], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, ids and ``text``: the labels of the ids, joined by one space."""
    definition = _definition(encoded, vocabulary)

    def run(stream):
        labels = _vocabulary(definition.value).labels
        shown = [(labels[at] + " ").encode("utf-8") if at in labels else b"" for at in range(max(labels) + 1)]
        lengths = np.array([len(label) for label in shown] + [0], np.int64)
        starts = np.cumsum(lengths) - lengths
        content = np.frombuffer(b"".join(shown), np.uint8)
        for batch in stream:
            for first in range(0, batch.num_rows, ROWS):
                some = batch.slice(first, ROWS)
                column = some["ids"]
                ids = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                ids[(ids < 0) | (ids >= len(shown))] = len(shown)
                counts = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                ends = np.append(0, np.cumsum(lengths[ids]))[np.append(0, np.cumsum(counts))]
                data = ragged(content, starts[ids], lengths[ids]).tobytes()
                texts = [data[a : max(a, b - 1)].decode("utf-8") for a, b in zip(ends[:-1], ends[1:])]
                gone = column.is_null().to_pylist()
                text = pa.array([None if no else value for no, value in zip(gone, texts)], pa.string())
                yield pa.RecordBatch.from_arrays([some["doc_id"], column, text], names=["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")
