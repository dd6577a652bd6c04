"""Secret scan by assignment-aware lexing.

Source and configuration text is read as name-literal pairs: name = "literal", "name": 'literal',
name: literal, name => literal, with sums of terms on the right. A term that is a name stands
for the literals assigned to it elsewhere in the text. Each literal is scored by the most
sensitive name it reaches and by how much it looks like a generated value.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict, deque

from pyspark.sql import DataFrame

from tradewind.llm.common import ship
from tradewind.llm.spans import Span, find_spans

ship(__name__)

# The base kinds in their order, and their patterns.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_WORDS = ("passw", "secret", "token", "api")
ASSIGN_MIN = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
# Runs are taken as a whole, so a run of 24 or more is a match of 24 or more.
HEX = re.compile(r"[0-9a-f]{24,}")

METHOD_KIND = "literal"
THRESHOLD = 0.5
# How sensitive a word within a name is.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "credential": 0.9, "credentials": 0.9, "bearer": 0.9, "authorization": 0.8, "auth": 0.6, "private": 0.5,
    "signature": 0.5, "salt": 0.6, "key": 0.4, "pass": 0.7,
}
# Words that make "key" sensitive.
KEY_WORDS = {"api", "access", "private", "secret", "encryption", "signing", "account", "master", "client", "auth"}
PLACEHOLDER = re.compile(
    r"^(?:change.?me.*|your.*|example.*|sample.*|dummy.*|todo|none|null|true|false|test|x+|\*+|\.+|<.*>|\$\{.*\}|\{\{.*\}\}|%\(.*)$",
    re.I)
OPERATOR = re.compile(r":=|=>|[:=]")
NAME_END = re.compile(r"[A-Za-z_$][\w$.-]*$", re.A)
NAME_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_$.-")
# A quoted literal on one line, and what follows one that is a key.
QUOTED = {q: re.compile(rf"{q}(?:[^{q}\\\n]|\\[\s\S])*+{q}") for q in "\"'`"}
QUOTED_KEY = re.compile(r"[ \t]*+(?::=|=>|[:=])")
NAME = re.compile(r"[A-Za-z_$][\w$.]*", re.A)
BARE = re.compile(r"[^\s,;#'\"()<>{}\[\]+]+")
BLANKS = re.compile(r"[ \t]*+")
# After a plus, and before one: blanks and at most one line end.
AFTER_PLUS = re.compile(r"[ \t]*+(?:\\?\r?\n[ \t]*+)?")
PLUS = re.compile(r"[ \t]*+(\\?\r?\n[ \t]*+)?\+")
# A line that starts with a plus and an assignment is a line of a patch.
ASSIGNS = re.compile(r"[A-Za-z_$][\w$.-]*+[\"'`]?[ \t]*+(?::=|=>|[:=])(?![=\s]*+$)", re.A | re.M)
# Terms that a sum within a bare term has at least before a further one within a bare term ends it.
INNER_TERMS = 16


def name_words(name: str) -> list[str]:
    """Parts of a name: at _ . - $ and where lower case turns into upper case."""
    spaced = re.sub(r"([a-z0-9])([A-Z])", r"\1 \2", name)
    return [w.lower() for w in re.split(r"[\s_.$-]+", spaced) if w]


def name_score(name: str) -> float:
    parts = name_words(name)
    best = max((SENSITIVE.get(p, 0.0) for p in parts), default=0.0)
    if "key" in parts and KEY_WORDS & set(parts):
        best = max(best, 1.0)
    return best


def value_score(value: str, quoted: bool) -> float:
    """0 for words and placeholders, towards 1 for values that look generated."""
    if len(value) < 8 or any(c.isspace() for c in value) or PLACEHOLDER.match(value):
        return 0.0
    counts = Counter(value)
    entropy = -sum(n / len(value) * math.log2(n / len(value)) for n in counts.values())
    kinds = sum((any(c.isdigit() for c in value), any(c.islower() for c in value), any(c.isupper() for c in value),
                 any(not c.isalnum() for c in value)))
    if not any(c.isdigit() for c in value) and (kinds < 3 or not quoted):
        return 0.0
    return min(1.0, entropy / 3.5) * (1.0 if kinds >= 2 else 0.6)


def _target(text: str, at: int) -> str | None:
    """The name that ends before an operator, without quotes or brackets."""
    while at and text[at - 1] in " \t":
        at -= 1
    while at and text[at - 1] in "\"'])":
        at -= 1
    start = at
    while start and text[start - 1] in NAME_CHARS:
        start -= 1
    found = NAME_END.search(text[start:at])
    return found[0] if found else None


def _terms(text: str, at: int, inner: bool = False) -> list[tuple[str, int, int, bool]]:
    """Terms of the right side: (text, start, end, quoted), joined by +, also where a line ends beside it.

    `inner` tells that the operator stands in a bare term of another sum, whose terms these are
    too. So that each term is read a bounded number of times, such a sum of many terms ends with
    a bare term that holds an operator itself.
    """
    out, size, new_line = [], len(text), False
    at = BLANKS.match(text, at).end()
    while at < size and text[at] != "\n":
        if text[at] in "\"'`":
            found = QUOTED[text[at]].match(text, at)
            if not found:
                break
            if new_line and QUOTED_KEY.match(text, found.end()):
                break
            out.append((text[at + 1:found.end() - 1], at + 1, found.end() - 1, True))
            at = found.end()
        else:
            found = BARE.match(text, at)
            if not found or new_line and ASSIGNS.match(text, at):
                break
            out.append((found[0], found.start(), found.end(), False))
            at = found.end()
            if inner and len(out) >= INNER_TERMS and OPERATOR.search(found[0]):
                break
        plus = PLUS.match(text, at)
        if not plus:
            break
        new_line = plus[1] is not None
        at = AFTER_PLUS.match(text, plus.end()).end()
    return out


def lex_pairs(text: str) -> list[tuple[str, list[tuple[str, int, int, bool]]]]:
    """Name and right-hand terms of every assignment-like place of a text."""
    pairs, end, read = [], 0, 0
    for found in OPERATOR.finditer(text):
        if found.start() < end:
            continue
        name = _target(text, found.start())
        if name is None:
            continue
        terms = _terms(text, found.end(), found.start() < read)
        if terms:
            pairs.append((name, terms))
            read = max(read, terms[-1][2])
            # What stands inside a quoted literal is no operator.
            end = max((t[2] for t in terms if t[3]), default=0)
    return pairs


def literal_spans(text: str) -> list[tuple[int, int, str, float]]:
    """(start, end, most sensitive name, score) of literals that reach a sensitive name."""
    pairs = lex_pairs(text)
    assigned = defaultdict(list)
    for name, terms in pairs:
        assigned[name].append(terms)
    best: dict[tuple[int, int], tuple[float, str]] = {}
    for name, terms in pairs:
        weight = name_score(name)
        if weight <= 0:
            continue
        seen, queue, parts = {name}, deque(terms), []
        while queue:
            value, start, end, quoted = queue.popleft()
            if not quoted and NAME.fullmatch(value) and value in assigned:
                if value not in seen:
                    seen.add(value)
                    queue.extendleft(reversed([t for ts in assigned[value] for t in ts]))
            else:
                parts.append((value, start, end, quoted))
        whole = value_score("".join(p[0] for p in parts), True) if len(parts) > 1 and any(p[3] for p in parts) else 0
        for value, start, end, quoted in parts:
            score = weight * max(value_score(value, quoted), whole if quoted else 0)
            if score >= THRESHOLD and score > best.get((start, end), (0, ""))[0]:
                best[start, end] = (score, name)
    return [(s, e, name, score) for (s, e), (score, name) in best.items()]


def scan(text: str) -> list[Span]:
    """All spans of a text by start, then kind; method spans inside a base span are left out."""
    spans: list[Span] = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        spans += [("assign", m.start(), m.end(), m[1].lower(), 1.0) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_MIN]
    if "AKIA" in text:
        spans += [("access", m.start(), m.end(), "", 1.0) for m in ACCESS.finditer(text)]
    spans += [("hex", m.start(), m.end(), "", 1.0) for m in HEX.finditer(text)]
    if "=" in text or ":" in text:
        covered = sorted((s[1], s[2]) for s in spans)
        spans += [
            (METHOD_KIND, s, e, name, score) for s, e, name, score in literal_spans(text)
            if not any(a <= s and e <= b for a, b in covered)]
    order = {k: i for i, k in enumerate((*KINDS, METHOD_KIND))}
    return sorted(spans, key=lambda s: (s[1], order[s[0]], s[2]))


def find_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) per row of (doc_id, text), each span with kind, place, target name, score.

    Row by row, without a shuffle. A null or empty text has no spans; repeated rows and null
    ids are passed on. Kinds are the base patterns and, for what only lexing finds, `literal`.
    """
    return find_spans(docs, lambda: lambda texts: [scan(t) for t in texts])
