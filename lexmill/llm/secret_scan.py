"""Secret scans: fixed patterns, and a linear-chain conditional random field that adds to them.

The patterns ("base") always count. The field tags tokens as secret begin (B),
inside (I) or outside (O) from their shape, the neighbouring words and features of
the whole text; Viterbi finds the best tags. It learns from the base spans of a
bounded sample of texts (``TRAIN_TEXTS`` with base spans, as many without), and
finds what stands and looks like them without matching a pattern.

Every token of a text is tagged, in one chain from its first token to its last. What
a token adds to the scores depends on features that many tokens share, so it is looked
up by number; and Viterbi only runs where the best path can leave O at all, by a bound
that is exact (``Field.open_runs``). It learns from runs of tokens: those around spans and
tokens that look like secrets, and some of the others.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Callable, Iterator
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm import tokens
from lexmill.llm.common import least_hashes, staged

KINDS = ("assign", "access", "hex", "model")

# The base patterns and the shortest match (assign: of its second group).
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
SHORTEST = {"assign": 6, "access": 20}

# A text without any of these has no assign match; upper-case letters count as lower-case.
KEYWORDS = ("passw", "secret", "token", "api")

# Words that often stand before a secret.
HINTS = frozenset(
    "password passwd pwd pass secret token key apikey api_key access auth bearer credential credentials private "
    "signature sig login session jwt client_secret access_key".split()
)

TRAIN_TEXTS = 1500
BEFORE = 3  # tokens of a training run before the one it is made for
PLAIN_RUNS = 2  # training runs of a text that are made for any of its tokens
EPOCHS = 8
DROPPED = 0.3  # of the features of a token, each time it is met in training, so that no clue is indispensable
TAGS = 3
O, B, I = range(TAGS)  # noqa: E741

_TOKEN = re.compile(r"""[^\s"'`<>()\[\]{},;]+""")
_DIGIT = re.compile(r"[0-9]")
_SIGN = re.compile("[=:]")
_PLAIN = re.compile("(?:(?P<lower>[a-zß-öø-ÿ]+)|(?P<capitalized>[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]+)|(?P<upper>[A-ZÀ-ÖØ-Þ]{2,}))[.!?$%&*#]*")
_C_LOG_C = [c * log2(c) if c else 0.0 for c in range(64)]
_REPEATED = re.compile(r"(.)\1+")

# Tokens a task remembers before it starts anew (some 60 MB).
REMEMBERED = 300_000


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base matches, sorted; offsets in code points."""
    found = []
    low = text.lower()
    if any(word in low for word in KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= SHORTEST["assign"]]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= SHORTEST["access"]]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


# --- tokens and features ----------------------------------------------------------------


def windows(text: str) -> list[list[tuple[int, int]]]:
    """The chains of a text, as tokens (start, end): one of all its tokens, if it has any."""
    whole = [m.span() for m in _TOKEN.finditer(text)]
    return [whole] if whole else []


def parted(text: str) -> tuple[list[str], list[str]]:
    """The tokens, and what is before the first, between them and after the last."""
    return _TOKEN.findall(text), _TOKEN.split(text)


def text_features(text: str) -> list[str]:
    """Features of the whole text: how much of it is digits, and whether it looks like settings or code."""
    n = max(len(text), 1)
    settings = text.count("=") + text.count(":")
    return [f"file digits {min(9, int(20 * len(_DIGIT.findall(text)) / n))}", f"file settings {min(5, int(200 * settings / n))}"]


def word_class(token: str) -> str:
    """A hint (which one does not matter), a sign such as "=" or ":", or any other word."""
    if token.lower().strip("=:") in HINTS:
        return "hint"
    return token if len(token) <= 2 and not token.isalnum() else "-"


def entropy_step(token: str) -> int:
    """The entropy of the characters of a token, in steps of half a bit."""
    n = len(token)
    if n < len(_C_LOG_C):
        repeated = sum(map(_C_LOG_C.__getitem__, map(token.count, set(token))))
    else:
        repeated = sum(c * log2(c) for c in Counter(token).values())
    return int(2 * (log2(n) - repeated / n) + 1e-9)


def plain_key(token: str) -> tuple | None:
    """What the features of a plain word depend on: 3 to 15 characters, letters of Latin-1 in lower case, in upper
    case, or capitalized, and then marks other than those of an assignment. None for other tokens."""
    found = 3 <= len(token) < 16 and _PLAIN.fullmatch(token)
    if not found:
        return None
    hexadecimal = not token.strip("0123456789abcdef")
    return len(token), entropy_step(token), found.lastgroup, token[found.end(found.lastgroup) :], token.lower() in HINTS, hexadecimal


def token_features(token: str) -> list[str]:
    n = len(token)
    size = "long" if n >= 16 else "short"
    if token.isascii() and token.isalpha() and token.islower():
        digits, kinds, turns, head = 0, "a", 1, ""
    else:
        digits = sum(map(str.isdigit, token))
        kinds = "".join(
            mark
            for mark, test in (("a", str.islower), ("A", str.isupper), ("9", str.isdigit))
            if any(map(test, token))
        ) + "".join(c for c in "+/_.=-:@%&#?" if c in token)
        turns = len(_REPEATED.sub(r"\1", "".join("9" if c.isdigit() else "a" if c.islower() else "A" if c.isupper() else c for c in token[:64])))
        head = _SIGN.split(token, maxsplit=1)[0].strip("\"'").lower() if _SIGN.search(token) else ""
    return [
        f"length {min(n.bit_length() * 2 + (n >> max(n.bit_length() - 2, 0) & 1), 14)}",
        f"kinds {kinds}",
        f"entropy {entropy_step(token)} {size}",
        f"digits {int(10 * digits / n)} {size}",
        f"turns {min(turns, 24) // 3}",
        f"assigned {'hint' if head in HINTS else bool(head)}",
        f"word {word_class(token)}",
        f"hexadecimal {not token.strip('0123456789abcdef')} {n >= 16}",
    ]


def gap_feature(gap: str) -> str:
    return f"between {gap.strip()[:3]}"


def near_features(step: int, features: list[str]) -> list[str]:
    """What a token with these features is to the one that many steps before or after it."""
    return [f"{step} {features[6]}", f"{step} {features[1]}"]


STEPS = (-2, -1, 1)


def feature_rows(words: list[str], gaps: list[str], of_text: list[str], places: range) -> list[list[str]]:
    """Features of the tokens at some places of a text."""
    own = {i: token_features(words[i]) for i in range(max(0, places.start - 2), min(len(words), places.stop + 1))}
    rows = []
    for i in places:
        row = ["bias", *own[i], *of_text, gap_feature(gaps[i]) if i else "between ^"]
        for step in STEPS:
            row += near_features(step, own[i + step]) if 0 <= i + step < len(words) else [f"{step} none"]
        rows.append(row)
    return rows


def window_tags(window: list[tuple[int, int]], spans: list[tuple[int, int, int]]) -> list[int]:
    """Tags of a window's tokens from spans: the first token that overlaps a span begins it."""
    merged: list[list[int]] = []
    for start, _, end in spans:
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    ends = [end for _, end in merged]
    tags, begun = [], None
    for a, b in window:
        first = bisect_right(ends, a)
        over = first if first < len(merged) and merged[first][0] < b else None
        tags.append(O if over is None else I if over == begun else B)
        begun = over
    return tags


# --- the field --------------------------------------------------------------------------


class Field:
    """Weights of a linear-chain conditional random field. A chain starts and ends outside; I never follows O."""

    def __init__(self, names: dict[str, int], weights: np.ndarray, moves: np.ndarray):
        self.names, self.weights, self.moves = names, weights, moves

    def scores(self, rows: list[list[str]]) -> np.ndarray:
        known = [[self.names[f] for f in row if f in self.names] for row in rows]
        return np.array([self.weights[k].sum(axis=0) for k in known]).reshape(-1, TAGS)

    def weight(self, features: list[str]) -> np.ndarray:
        """What some features add to the score of each tag."""
        return self.weights[[self.names[f] for f in features if f in self.names]].sum(axis=0)

    def decode(self, scores: np.ndarray) -> list[int]:
        """Viterbi."""
        best, back = self.moves[O] + scores[0], []
        for row in scores[1:]:
            paths = best[:, None] + self.moves
            back.append(paths.argmax(axis=0))
            best = paths.max(axis=0) + row
        tag = int((best + self.moves[:, O]).argmax())
        tags = [tag]
        for step in reversed(back):
            tag = int(step[tag])
            tags.append(tag)
        return tags[::-1]

    def open_runs(self, scores: np.ndarray) -> list[tuple[int, int]]:
        """Runs [first, end) of a chain outside of which every token of a best path is O.

        A run of other tags changes the score of a path by no more than the sum of ``gain`` over its
        tokens and ``end``; where the largest such sum of the runs through a token is
        negative, a path is better with O there.
        """
        stay = self.moves[O, O]
        inside = max(self.moves[O, B], self.moves[B:, B:].max()) - stay
        end = self.moves[B:, O].max() - stay
        sums = np.append(0.0, np.cumsum(scores[:, B:].max(axis=1) - scores[:, O] + inside))
        most = np.maximum.accumulate(sums[:0:-1])[::-1] - np.minimum.accumulate(sums[:-1])
        edges = np.flatnonzero(np.diff(np.concatenate([[False], most + end >= -1e-6, [False]]).astype(np.int8)))
        return list(zip(edges[::2].tolist(), edges[1::2].tolist()))

    def best_tags(self, scores: np.ndarray) -> list[tuple[int, list[int]]]:
        """Best tags of a chain: (first, tags) of some runs, all other tokens are O."""
        return [(first, self.decode(scores[first:end])) for first, end in self.open_runs(scores)]

    def expected(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of tags, and expected numbers of moves, by forward and backward sums."""
        n = len(scores)
        ahead, behind = np.zeros((n, TAGS)), np.zeros((n, TAGS))
        ahead[0] = self.moves[O] + scores[0]
        for i in range(1, n):
            ahead[i] = np.logaddexp.reduce(ahead[i - 1][:, None] + self.moves, axis=0) + scores[i]
        behind[-1] = self.moves[:, O]
        for i in range(n - 2, -1, -1):
            behind[i] = np.logaddexp.reduce(self.moves + (scores[i + 1] + behind[i + 1])[None, :], axis=1)
        total = np.logaddexp.reduce(ahead[-1] + behind[-1])
        tags = np.exp(ahead + behind - total)
        moves = np.zeros((TAGS, TAGS))
        for i in range(1, n):
            moves += np.exp(ahead[i - 1][:, None] + self.moves + (scores[i] + behind[i])[None, :] - total)
        moves[O] += tags[0]
        moves[:, O] += tags[-1]
        return tags, moves


class Kinds(dict):
    """The number of a token's or gap's kind: those with the same features have one, and a row of ``table``."""

    def __init__(self, key_of: Callable[[str], tuple | None], features_of: Callable[[str], list[list[str]]], field: Field):
        super().__init__()
        self.key_of, self.features_of, self.field = key_of, features_of, field
        self.known: dict[tuple, int] = {}
        self.rows: list[np.ndarray] = []
        self.table = np.empty((0, 0, TAGS))

    def __missing__(self, value: str) -> int:
        short = self.key_of(value)
        number = self.known.get(short) if short else None
        if number is None:
            groups = self.features_of(value)
            key = tuple(map(tuple, groups))
            number = self.known.get(key)
            if number is None:
                number = self.known[key] = len(self.rows)
                self.rows.append(np.array([self.field.weight(features) for features in groups]))
            if short:
                self.known[short] = number
        self[value] = number
        return number

    def numbers(self, values: list[str]) -> np.ndarray:
        """Numbers of values; ``table[number]`` has the weights of each group of features."""
        if len(self) > REMEMBERED:
            self.clear()
        found = np.fromiter(map(self.__getitem__, values), np.int64, len(values))
        if len(self.table) < len(self.rows):
            self.table = np.array(self.rows)
        return found


class Scorer:
    """Scores of all tokens of a text: those of ``Field.scores`` for ``feature_rows``, by numbers of kinds."""

    def __init__(self, field: Field):
        def of_token(token: str) -> list[list[str]]:
            own = token_features(token)
            return [["bias", *own], *(near_features(step, own) for step in STEPS)]

        self.field = field
        self.tokens = Kinds(plain_key, of_token, field)
        self.gaps = Kinds(lambda gap: None, lambda gap: [[gap_feature(gap)]], field)
        self.first = field.weight(["between ^"])
        self.none = [field.weight([f"{step} none"]) for step in STEPS]

    def scores(self, words: list[str], gaps: list[str], of_text: list[str]) -> np.ndarray:
        number, gap = self.tokens.numbers(words), self.gaps.numbers(gaps[:-1])
        scores = self.tokens.table[number, 0] + self.field.weight(of_text)
        scores[1:] += self.gaps.table[gap[1:], 0]
        scores[0] += self.first
        for k, step in enumerate(STEPS):
            near = self.tokens.table[number, k + 1]
            if step < 0:
                scores[-step:] += near[:step]
                scores[:-step] += self.none[k]
            else:
                scores[:-step] += near[step:]
                scores[-step:] += self.none[k]
        return scores


def fit(chains: list[tuple[list[list[str]], list[int]]], seed: int = 1) -> Field:
    """A field fitted by stochastic gradient ascent (AdaGrad) on the likelihood of tagged runs."""
    counts = Counter(f for rows, _ in chains for row in rows for f in row)
    names = {f: i for i, f in enumerate(sorted(f for f, c in counts.items() if c >= 3))}
    moves = np.zeros((TAGS, TAGS))
    moves[O, I] = -1e4
    field = Field(names, np.zeros((len(names), TAGS)), moves)
    squares, move_squares = np.full(field.weights.shape, 1e-2), np.full(moves.shape, 1e-2)
    known = [([[names[f] for f in row if f in names] for row in rows], tags) for rows, tags in chains]
    order = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for c in order.permutation(len(known)):
            rows, tags = known[c]
            rows = [[f for f, x in zip(k, order.random(len(k))) if x >= DROPPED] for k in rows]
            scores = np.array([field.weights[k].sum(axis=0) for k in rows])
            chance, expected = field.expected(scores)
            change = -expected
            for a, b in zip([O, *tags], [*tags, O]):
                change[a, b] += 1
            for k, tag, p in zip(rows, tags, chance):
                step = -p
                step[tag] += 1
                gradient = step[None, :] - 1e-4 * field.weights[k]
                squares[k] += gradient**2
                field.weights[k] += 0.2 * gradient / np.sqrt(squares[k])
            change[O, I] = 0
            move_squares += change**2
            field.moves += 0.2 * change / np.sqrt(move_squares)
    return field


def training_runs(words: list[str], tags: list[int]) -> list[range]:
    """Runs of tokens to learn from: around every token in a span, or of 8 or more characters with a digit, and
    around ``PLAIN_RUNS`` others at even distances. A run begins and ends outside of spans."""
    places = [i for i, w in enumerate(words) if tags[i] != O or len(w) >= 8 and _DIGIT.search(w)]
    places += [(2 * k + 1) * len(words) // (2 * PLAIN_RUNS) for k in range(PLAIN_RUNS)] if words else []
    runs: list[list[int]] = []
    for i in sorted(places):
        start, end = max(0, i - BEFORE), min(len(words), i + 2)
        while start and tags[start - 1] != O:
            start -= 1
        while end < len(words) and tags[end] != O:
            end += 1
        if runs and start <= runs[-1][1]:
            runs[-1] = [min(start, runs[-1][0]), max(end, runs[-1][1])]
        else:
            runs.append([start, end])
    return [range(start, end) for start, end in runs]


def training_chains(texts: list[str]) -> list[tuple[list[list[str]], list[int]]]:
    chains = []
    for text in texts:
        spans, of_text, (words, gaps) = base_spans(text), text_features(text), parted(text)
        for window in windows(text):
            tags = window_tags(window, spans)
            for run in training_runs(words, tags):
                chains.append((feature_rows(words, gaps, of_text, run), tags[run.start : run.stop]))
    return chains


def train(docs: DataFrame, train_texts: int = TRAIN_TEXTS) -> Field | None:
    """A field from ``train_texts`` texts with base spans and as many without but with digits: those with the
    smallest hash. None if no text has a base span. Training texts over 100,000 characters are passed over.

    Hashes are compared first, so that the driver only gets the texts it trains on.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    kinds = {
        "spans": F.rlike("text", F.lit(r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]"))
        | F.rlike("text", F.lit(r"AKIA[A-Z0-9]{16}|[0-9a-f]{24}")),
        "digits": F.rlike("text", F.lit(r"[0-9]{3}")),
    }
    sample = docs.select(text.alias("text")).where(F.char_length("text") <= 100_000)
    sample = sample.withColumn("hash", F.xxhash64("text"))
    marked = staged(sample.select("hash", *(test.alias(kind) for kind, test in kinds.items())), "text-kinds")
    chosen: set[int] = set()
    for kind in kinds:
        hashes = staged(marked.where(kind).select("hash").distinct(), "text-hashes")
        chosen |= {r["hash"] for r in least_hashes(hashes, "hash", train_texts).collect()}
    found = docs.sparkSession.createDataFrame([(h,) for h in sorted(chosen)], "hash long")
    picked = sample.join(F.broadcast(found), "hash", "left_semi").groupBy("hash").agg(F.min("text").alias("text"))
    chains = training_chains([r["text"] for r in picked.orderBy("hash").collect()])
    return fit(chains) if any(B in tags for _, tags in chains) else None


# --- scanning ---------------------------------------------------------------------------


def model_spans(text: str, scorer: Scorer, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """What the field tags as secret and no base span overlaps."""
    words, gaps = parted(text)
    if not words:
        return []
    tagged = scorer.field.best_tags(scorer.scores(words, gaps, text_features(text)))
    if not any(tag != O for _, tags in tagged for tag in tags):
        return []
    places = windows(text)[0]
    starts = [s for s, _, _ in base]
    found = []
    for first, tags in tagged:
        spans: list[list[int]] = []
        for (a, b), tag in zip(places[first:], tags):
            if tag == B:
                spans.append([a, b])
            elif tag == I:
                spans[-1][1] = b
        for a, b in spans:
            near = base[max(0, bisect_left(starts, a) - 4) : bisect_left(starts, b)]
            if not any(s < b and a < e for s, _, e in near):
                found.append((a, 3, b))
    return found


def scan(docs: DataFrame, field: Field | None) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base, spans) for every row of ``docs(doc_id, text)``.

    ``base`` and ``spans`` are comma-joined kind:start:end, the latter with the field's
    spans (kind "model"). A null text counts as empty and has none. Repeated rows come
    back as often; other columns are not read; an empty table gives no rows.
    """
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base", "spans"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = field and Scorer(field)
        for batch in batches:
            rows = []
            for text in tokens.texts_of(batch.column(1)):
                base = base_spans(text)
                more = model_spans(text, scorer, base) if scorer else []
                kinds = [kind for _, kind, _ in base]
                rows.append((*(kinds.count(k) for k in range(3)), joined(base), joined(sorted(base + more))))
            columns = list(zip(*rows)) or [[]] * 5
            types = [pa.int64()] * 3 + [pa.string()] * 2
            made = [pa.array(c, t) for c, t in zip(columns, types)]
            yield pa.record_batch([batch.column(0), *made], names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(search, "doc_id long, n_assign long, n_access long, n_hex long, base string, spans string")

