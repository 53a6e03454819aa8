"""Secret scan: fixed patterns, and automata inferred from labelled credentials.

Credentials that the patterns label in the corpus are read into a prefix tree with counts; states
whose onward frequencies agree (Hoeffding bound) are merged, which gives a probabilistic automaton
per kind. Every long token is a candidate and scored by its likelihood under these automata against
one of ordinary long tokens.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodtide.llm.common import pieces, written

# Kinds in their order, and the patterns of the base.
KINDS = ("assign", "access", "hex", "model")
_ASSIGN = re.compile(
    r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
LEAST = {"assign": 6, "access": 20, "hex": 24}

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}+")


def candidates(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in CANDIDATE.finditer(text)]


def base_spans(text: str, tokens: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns. ``tokens``: the candidates of the text.

    A run of 24 hexadecimal digits and a key of 20 characters always lie within one candidate.
    """
    found = []
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        for m in _ASSIGN.finditer(text):
            if len(m.group(2)) >= LEAST["assign"]:
                found.append((m.start(), 0, m.end()))
    for a, b in tokens:
        if b - a >= LEAST["access"]:
            for k, pattern in ((1, _ACCESS), (2, _HEX)):
                for m in pattern.finditer(text, a, b):
                    if m.end() - m.start() >= LEAST[KINDS[k]]:
                        found.append((m.start(), k, m.end()))
    return sorted(found)


def _symbol(c: str) -> str:
    if c.isdigit():
        return "0"
    if c in "abcdef":
        return "a"
    if c in "ABCDEF":
        return "A"
    if "a" <= c <= "z":
        return "z"
    if "A" <= c <= "Z":
        return "Z"
    return c


_SYMBOLS = {chr(i): _symbol(chr(i)) for i in range(128)}
# How many characters a symbol stands for; a symbol's mass is spread evenly over them.
_WIDTH = defaultdict(lambda: 1, {"0": 10, "a": 6, "A": 6, "z": 20, "Z": 20})


def symbols(token: str) -> str:
    return "".join(_SYMBOLS.get(c, "?") for c in token)


class Automaton:
    """Probabilistic automaton by state merging over a prefix tree (frequencies, Hoeffding test)."""

    def __init__(self, words: list[str], alpha: float = 0.05):
        self.next: list[dict[str, int]] = [{}]
        self.count: list[dict[str, int]] = [defaultdict(int)]  # per symbol; "" is the end
        self.total = [0]
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        for word in words:
            s = 0
            for c in word:
                self.total[s] += 1
                self.count[s][c] += 1
                if c not in self.next[s]:
                    self.next[s][c] = len(self.next)
                    self.next.append({})
                    self.count.append(defaultdict(int))
                    self.total.append(0)
                s = self.next[s][c]
            self.total[s] += 1
            self.count[s][""] += 1
        self._merge()
        self.states = self._reachable()

    def _differ(self, a: int, b: int) -> bool:
        n, m = self.total[a], self.total[b]
        if not n or not m:
            return False
        limit = self.bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))
        return any(
            abs(self.count[a].get(c, 0) / n - self.count[b].get(c, 0) / m) > limit
            for c in {*self.count[a], *self.count[b]}
        )

    def _compatible(self, a: int, b: int) -> bool:
        stack, seen = [(a, b)], set()
        while stack:
            pair = stack.pop()
            if pair in seen:
                continue
            seen.add(pair)
            if self._differ(*pair):
                return False
            x, y = self.next[pair[0]], self.next[pair[1]]
            stack += [(x[c], y[c]) for c in x if c in y]
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the tree below b to a."""
        stack = [(a, b)]
        while stack:
            x, y = stack.pop()
            self.total[x] += self.total[y]
            for c, n in self.count[y].items():
                self.count[x][c] += n
            for c, t in self.next[y].items():
                if c in self.next[x]:
                    stack.append((self.next[x][c], t))
                else:
                    self.next[x][c] = t

    def _merge(self) -> None:
        red, queue = [0], [(0, c) for c in sorted(self.next[0])]
        known = {0}
        while queue:
            parent, c = queue.pop(0)
            blue = self.next[parent].get(c)
            if blue is None or blue in known:
                continue
            for r in red:
                if self._compatible(r, blue):
                    self.next[parent][c] = r
                    self._fold(r, blue)
                    break
            else:
                red.append(blue)
                known.add(blue)
            queue = [(r, c) for r in red for c in sorted(self.next[r]) if self.next[r][c] not in known]

    def _reachable(self) -> dict[int, dict[str, tuple[float, int]]]:
        """Per state: symbol -> (log probability of one character, next state); smoothed by one count."""
        alphabet = {c for s in self.count for c in s} | {"", "0", "a", "A", "z", "Z", "?", *"+/_.=-"}
        out, stack = {}, [0]
        while stack:
            s = stack.pop()
            if s in out:
                continue
            base = math.log(self.total[s] + len(alphabet))
            out[s] = {
                c: (math.log(self.count[s].get(c, 0) + 1) - base - math.log(_WIDTH[c]), self.next[s].get(c, 0))
                for c in alphabet
            }
            stack += self.next[s].values()
        return out

    def log_likelihood(self, word: str) -> float:
        s, total = 0, 0.0
        for c in word:
            p, s = self.states[s].get(c) or self.states[s]["?"]
            total += p
        return total + self.states[s][""][0]


def labelled_credentials(docs: DataFrame, text: str = "text", per_kind: int = 1000) -> dict[str, list[str]]:
    """A bounded sample of the labelled credentials of each kind, and of other long tokens (``model``).

    Distinct values in the order of a hash, ``per_kind`` of each kind (parameter of the fit, not of
    the scan, which covers every token).
    """

    def find(batches):
        for batch in pieces(batches, text):
            kinds, values = [], []
            for t in batch.column(text).to_pylist():
                tokens = candidates(t or "")
                base = base_spans(t or "", tokens)
                for a, k, b in base:
                    value = t[a:b]
                    kinds.append(KINDS[k])
                    values.append(_ASSIGN.match(value).group(2) if k == 0 else value)
                for a, b in tokens:
                    if not any(x < b and a < y for x, _, y in base):
                        kinds.append("model")
                        values.append(t[a:b])
            pairs = sorted(set(zip(kinds, map(symbols, values), strict=True)))
            yield pa.RecordBatch.from_pydict(
                {"kind": pa.array([p[0] for p in pairs], pa.string()), "value": pa.array([p[1] for p in pairs], pa.string())}
            )

    values = written(docs.select(text).mapInArrow(find, "kind string, value string").distinct(), "credentials")
    order = (F.xxhash64("value"), "value")
    return {
        k: [r["value"] for r in values.filter(F.col("kind") == k).orderBy(*order).limit(per_kind).collect()]
        for k in KINDS
    }


def fit(sample: dict[str, list[str]], alpha: float = 0.05) -> tuple[list[Automaton], Automaton]:
    """(one automaton per kind with samples, the one of other tokens). Values are symbol strings."""
    return [Automaton(sample[k], alpha) for k in KINDS[:3] if sample[k]], Automaton(sample["model"], alpha)


def scan(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    per_kind: int = 1000,
    margin: float = 12.0,
    keep: tuple[str, ...] = (),
    redacted: str | None = None,
) -> DataFrame:
    """Spans of secrets in every text: counts per fixed kind, a digest of those, and all spans.

    A candidate that does not lie inside a fixed span gets a ``model`` span if its log-likelihood under the best
    credential automaton exceeds that under the automaton of other tokens by ``margin``. Spans are
    kind:start:end in code points, end exclusive, by start, then kind.

    Null and empty texts have no spans; repeated rows give repeated results; without any labelled
    credential nothing is added to the fixed spans. ``keep`` names further columns to carry,
    ``redacted`` a column for the text with its spans replaced by a mark (null stays null).
    """
    credentials, other = fit(labelled_credentials(docs, text, per_kind))

    def is_secret(token: str) -> bool:
        word = symbols(token)
        if not credentials:
            return False
        return max(a.log_likelihood(word) for a in credentials) - other.log_likelihood(word) >= margin

    def find(batches):
        for batch in pieces(batches, text):
            counts, digests, spans, clean = [], [], [], []
            for t in batch.column(text).to_pylist():
                t = t or ""
                tokens = candidates(t)
                base = base_spans(t, tokens)
                counts.append([sum(k == x for _, k, _ in base) for x in range(3)])
                listed = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in base)
                digests.append(hashlib.sha256(listed.encode()).hexdigest())
                more = [
                    (a, 3, b) for a, b in tokens if not any(x <= a and b <= y for x, _, y in base) and is_secret(t[a:b])
                ]
                spans.append(",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(base + more)))
                if redacted is not None and spans[-1]:
                    clean.append((len(spans) - 1, redact(t, spans[-1])))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(doc_id),
                    *(pa.array([c[k] for c in counts], pa.int64()) for k in range(3)),
                    pa.array(digests, pa.string()),
                    pa.array(spans, pa.string()),
                    *(batch.column(c) for c in extra),
                    *([] if redacted is None else [_replaced(batch.column(text), clean)]),
                ],
                names=[doc_id, "n_assign", "n_access", "n_hex", "base_sha256", "spans", *extra, *added],
            )

    extra = [c for c in keep if c != doc_id]
    added = [] if redacted is None else [redacted]
    own = docs.select(doc_id, *(c for c in dict.fromkeys([text, *keep]) if c != doc_id))
    kind = own.schema[doc_id].dataType.simpleString()
    carried = "".join(f", `{c}` {own.schema[c].dataType.simpleString()}" for c in extra)
    carried += "".join(f", `{c}` string" for c in added)
    schema = f"`{doc_id}` {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string{carried}"
    return own.mapInArrow(find, schema)


def _replaced(texts: pa.Array, new: list[tuple[int, str]]) -> pa.Array:
    """``texts`` with those of the given places exchanged; the others are not copied to Python."""
    texts = texts.cast(pa.string())
    if not new:
        return texts
    mask = np.zeros(len(texts), bool)
    mask[[i for i, _ in new]] = True
    return pc.replace_with_mask(texts, pa.array(mask), pa.array([t for _, t in new], pa.string()))


def redact(text: str | None, spans: str, mark: str = "[SECRET]") -> str | None:
    """``text`` with every span replaced by ``mark``; overlapping spans count as one."""
    if not text or not spans:
        return text
    out, at = [], 0
    for a, b in sorted((int(a), int(b)) for _, a, b in (s.split(":") for s in spans.split(","))):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])
