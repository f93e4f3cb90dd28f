"""Secret scans by assignment-aware lexing.

Base spans are three plain patterns (assign, access, hex). The method adds ``lexed`` spans. A lexer cuts a text into strings (also
triple-quoted), comments, operators, brackets and tags, and reads from them pairs of a target name and what it is given:

* ``name = value``, ``:``, ``:=``, ``=>``, also with a type (``name: str = value``) and with the name quoted or in a subscript;
* what a value is made of: string literals, their concatenations, names, bare words of configuration files, and the arguments after
  the first of a call (``getenv("NAME", "default")``, whose first argument is a target name too);
* ``#define NAME value``, ``<name>value</name>``, and block scalars of YAML.

A name that is given stands for the last definition before it whose block (braces) encloses it, or else for the first one after it, and is
followed through any number of names to the literals that it is made of. A literal is scored by the most sensitive target name
that it reaches, and by the length, mixture and entropy of the whole value. Comments and the contents of strings are lexed by themselves:
their names neither give values to code around them nor take any.

Positions are code points, end exclusive. Defined cases: null and empty texts have no spans; a text of any length is read whole in
time linear in it; rows that repeat are each scanned; other columns are ignored.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import map_texts

KINDS = ("assign", "access", "hex", "lexed")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")

#: Weight of a word in a target name; names from SENSITIVE_NAME on are looked at.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "apikey": 1.0, "credential": 0.9,
    "credentials": 0.9, "auth": 0.6, "key": 0.5, "private": 0.5, "access": 0.4, "api": 0.4, "signing": 0.5, "client": 0.2,
    "bearer": 0.8, "salt": 0.5, "dsn": 0.6, "webhook": 0.4, "session": 0.3, "cookie": 0.4, "encryption": 0.5, "master": 0.3,
}
SENSITIVE_NAME = 0.8
#: Words that say the name holds something else.
HARMLESS = frozenset("public name id path file url uri count length size type field label hint expires expiry ttl limit policy".split())
PLACEHOLDER = re.compile(r"(?is)^(?:x+|\*+|changeme|example|none|null|true|false|todo|your[_-].*|<.*>|\$\{.*\}|\{\{.*\}\}|%.*%)$")
#: A sensitive name holds one of these: the sensitive words without those that hold a shorter one.
_ROOTS = [w for w in SENSITIVE if not any(o in w for o in SENSITIVE if o != w)]
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")

_TOKEN = re.compile(
    r"""(?P<quote>\"{3}|'{3}|["'`])|(?P<define>\#[ \t]*define[ \t]+(?=[A-Za-z_]))|(?P<comment>/\*|<!--|(?<!:)//+|\#+)|(?P<open>[(\[{])|(?P<close>[)\]}])|(?P<comma>,)"""
    r"""|(?P<op>:=|=>|(?<![=!<>:+*/|&^%-])=(?![=~])|(?<!:):(?![:/]))|<(?P<tag>[A-Za-z_][\w.-]*)(?=[ \t/>])"""
)
_LINE = re.compile(r"[^\n]*")
_BLANKS = re.compile(r"[ \t]*")
_JOIN = re.compile(r"[ \t]*(?:\+|\.\.?|&|\|\|)(?:[ \t]|\\?\r?\n)*(?=[frbuFRBU]{0,2}[\"'`])|[ \t]+(?:\+|\.\.|&|\|\|)(?:[ \t]|\\?\r?\n)+(?=[A-Za-z_])")
_PREFIX = re.compile(r"[frbuFRBU]{0,2}(?=[\"'`])")
_IDENT = re.compile(r"[A-Za-z_][A-Za-z0-9_]*(?:(?:\.|->|::)[A-Za-z_][A-Za-z0-9_]*)*")
_TYPE = re.compile(r"[A-Za-z_][\w.]*(?:\[[\w., |]*\])?[ \t]*=(?![=~])[ \t]*(?=[frbuFRBU]{0,2}[\"'`])")
_BARE = re.compile(r"[A-Za-z0-9+/_.=~@!#$%^&*-]+")
_NAME_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_.$-")
_BLOCK = re.compile(r"[ \t]*[|>][+-]?[0-9]?[ \t]*(?:\#[^\n]*)?\r?\n")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the three patterns."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12] if ":" in text or "=" in text else []
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    return found + [(m.start(), 2, m.end()) for m in HEX.finditer(text)]


def name_score(name: str) -> float:
    parts = [p.lower() for p in _PARTS.findall(name.rsplit(".", 1)[-1])]
    if not parts or parts[-1] in HARMLESS:
        return 0.0
    return sum(SENSITIVE.get(p, 0.0) for p in set(parts)) + (1.0 if "".join(parts) in ("apikey", "secretkey", "privatekey", "accesskey") else 0.0)


def worth(counts: Counter) -> float:
    """0 to 1: length, mixture and entropy of a value by its counts of characters."""
    n = sum(counts.values())
    if n < 8:
        return 0.0
    bits = math.log2(n) - sum(c * math.log2(c) for c in counts.values()) / n
    kinds = sum(any(map(p, counts)) for p in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum()))
    return min(1.0, bits / 3.5) * (0.5 if " " in counts else 1.0) * (1.0 if kinds >= 2 or n >= 20 else 0.4)


def literal_score(value: str) -> float:
    return 0.0 if PLACEHOLDER.match(value) else worth(Counter(value))


def may_name(text: str) -> bool:
    """Whether any sensitive word occurs, in whatever case."""
    low = text.lower()
    return any(w in low for w in _ROOTS)


class Region:
    """Strings, operators and brackets of one stretch of text: code, a comment, or the contents of a string."""

    def __init__(self, text: str, start: int, end: int, said: bool = False):
        self.text, self.start, self.end, self.said = text, start, end, said  # said: inside a comment, where none opens to the end of the line
        self.strings: dict[int, tuple[int, int, int]] = {}  # opening place -> contents, end
        self.inner: list[tuple[int, int, bool]] = []
        self.ops: list[tuple[int, int]] = []
        self.defines: list[int] = []
        self.tags: list[tuple[str, int]] = []
        self.calls: dict[int, list[tuple[int, int]]] = defaultdict(list)  # opening place -> (argument, string)
        self.blocks: list[int] = [start]
        self._parent: dict[int, int] = {start: -1}
        self._read()

    def _read(self) -> None:
        text, end, at = self.text, self.end, self.start
        stack: list[list[int]] = []  # opening place, number of the argument
        block, gone = self.start, {}
        self.of = [self.start]
        while m := _TOKEN.search(text, at, end):
            kind, i = m.lastgroup, m.start()
            at = m.end()
            if kind == "quote":
                if text[i] == "'" and i > self.start and text[i - 1].isalnum() and not self._prefixed(i):
                    continue
                closed = self._closing(m[0], at, gone)
                if closed < 0:
                    at = i + 1
                    continue
                self.strings[i] = (at, closed, closed + len(m[0]))
                self.inner.append((at, closed, self.said))
                if stack:
                    self.calls[stack[-1][0]].append((stack[-1][1], i))
                at = closed + len(m[0])
            elif kind == "define":
                self.defines.append(at)
            elif kind == "comment":
                if m[0][0] == "#" or m[0][:2] == "//":
                    if self.said:
                        continue
                    stop = _LINE.match(text, at, end).end()
                else:
                    mark = "*/" if m[0] == "/*" else "-->"
                    stop = self._find(mark, at, gone)
                    if stop < 0:
                        continue
                self.inner.append((at, stop, True))
                at = stop
            elif kind == "open":
                stack.append([i, 0])
                if m[0] == "{":
                    self._parent[i], block = block, i
                    self.blocks.append(i)
                    self.of.append(block)
            elif kind == "close":
                if stack:
                    stack.pop()
                if m[0] == "}" and self._parent[block] >= 0:
                    block = self._parent[block]
                    self.blocks.append(i)
                    self.of.append(block)
            elif kind == "comma":
                if stack:
                    stack[-1][1] += 1
            elif kind == "op":
                self.ops.append((i, at))
            else:
                self.tags.append((m["tag"], at))

    def _prefixed(self, i: int) -> bool:
        """Whether the quote at i has a string prefix, not a word, before it."""
        k = i
        while k > self.start and i - k < 3 and self.text[k - 1] in "frbuFRBU":
            k -= 1
        return i - k < 3 and (k == self.start or not (self.text[k - 1].isalnum() or self.text[k - 1] == "_"))

    def _find(self, mark: str, at: int, gone: dict) -> int:
        """Next ``mark``, or -1; that there is none is remembered, so it is found out once."""
        if mark in gone:
            return -1
        got = self.text.find(mark, at, self.end)
        if got < 0:
            gone[mark] = True
        return got

    def _closing(self, mark: str, at: int, gone: dict) -> int:
        if len(mark) == 3:
            return self._find(mark, at, gone)
        text, line = self.text, at
        while True:
            got = self._find(mark, line, gone)
            if got < 0:
                return -1
            if mark != "`" and text.find("\n", at, got) >= 0:
                return -1
            back = got
            while back > at and text[back - 1] == "\\":
                back -= 1
            if (got - back) % 2 == 0:
                return got
            line = got + 1

    def block(self, at: int) -> int:
        return self.of[bisect.bisect_right(self.blocks, at) - 1]

    def around(self, block: int) -> int:
        return self._parent[block]

    def name_before(self, i: int, least: int) -> str | None:
        """The name that ends before i: plain, quoted, or the string of a subscript."""
        text = self.text
        while i > least and text[i - 1] in " \t":
            i -= 1
        if i > least and text[i - 1] == "]":
            i -= 1
            if not (i > least and text[i - 1] in "\"'"):
                return None
        if i > least and text[i - 1] in "\"'`":
            start = self.ends.get(i)
            return text[self.strings[start][0] : self.strings[start][1]] if start is not None and start >= least else None
        k = i
        while k > least and text[k - 1] in _NAME_CHARS:
            k -= 1
        name = text[k:i].lstrip("-.$0123456789")
        return name or None

    @property
    def ends(self) -> dict[int, int]:
        if not hasattr(self, "_ends"):
            self._ends = {e: i for i, (_, _, e) in self.strings.items()}
        return self._ends

    def string_at(self, i: int) -> tuple[int, int, int] | None:
        return self.strings.get(_PREFIX.match(self.text, i, self.end).end()) if _PREFIX.match(self.text, i, self.end) else None

    def value(self, i: int) -> tuple[list[tuple], int]:
        """What is given from i on: parts ("lit", start, end), ("bare", start, end) or ("name", start, end), and where it ends."""
        text, end, parts = self.text, self.end, []
        i = _BLANKS.match(text, i, end).end()
        if m := _TYPE.match(text, i, end):
            i = m.end()
        while True:
            if got := self.string_at(i):
                parts.append(("lit", got[0], got[1]))
                i = got[2]
                nxt = _BLANKS.match(text, i, end).end()
                if self.string_at(nxt):
                    i = nxt
                    continue
            elif m := _IDENT.match(text, i, end):
                bare = _BARE.match(text, i, end)
                joined = _JOIN.match(text, m.end(), end)
                if m.end() < end and text[m.end()] == "(":
                    for arg, k in self.calls.get(m.end(), ()):
                        if arg:
                            parts.append(("lit", *self.strings[k][:2]))
                    return parts, m.end()
                if not joined and bare.end() > m.end():
                    return self._bare(parts, bare)
                parts.append(("name", i, m.end()))
                i = m.end()
            elif bare := _BARE.match(text, i, end):
                return self._bare(parts, bare)
            else:
                return parts, i
            if not (m := _JOIN.match(text, i, end)):
                return parts, i
            i = m.end()

    def _bare(self, parts: list[tuple], bare: re.Match) -> tuple[list[tuple], int]:
        stop = bare.end()
        while stop > bare.start() and self.text[stop - 1] == ".":
            stop -= 1
        if not parts and stop > bare.start():
            parts.append(("bare", bare.start(), stop))
        return parts, bare.end()

    def given(self):
        """(name, place, parts) of every definition."""
        text, after = self.text, self.start
        for i, j in self.ops:
            if i < after:
                continue
            name = self.name_before(i, self.start)
            if not name:
                continue
            if text[i] == ":" and (m := _BLOCK.match(text, j, self.end)):
                if got := self._scalar(i, m.end()):
                    yield name, i, [("lit", *got)]
                continue
            parts, stop = self.value(j)
            if parts and parts[-1][0] == "bare":
                after = stop
            yield name, i, parts
        for i in self.defines:
            m = _IDENT.match(text, i, self.end)
            if m.end() < self.end and text[m.end()] in " \t":
                yield m[0], i, self.value(m.end())[0]
        for name, i in self.tags:
            begin = text.find(">", i, self.end)
            if begin >= 0 and text.find("<", i, begin) < 0:
                stop = text.find("<", begin, self.end)
                if stop >= 0 and text.startswith(f"</{name}", stop):
                    lead = len(text[begin + 1 : stop]) - len(text[begin + 1 : stop].lstrip())
                    body = text[begin + 1 : stop].strip()
                    if body:
                        yield name, i, [("lit", begin + 1 + lead, begin + 1 + lead + len(body))]
        for args in self.calls.values():
            first = [self.strings[k] for a, k in args if a == 0]
            rest = [("lit", *self.strings[k][:2]) for a, k in args if a]
            if len(first) == 1 and rest:
                yield text[first[0][0] : first[0][1]], first[0][0], rest

    def _scalar(self, op: int, at: int) -> tuple[int, int] | None:
        """The lines from ``at`` on that are indented deeper than the line of the operator."""
        text = self.text
        line = text.rfind("\n", self.start, op) + 1 or self.start
        depth = len(_BLANKS.match(text, line, self.end)[0])
        begin = stop = None
        while at < self.end:
            whole = _LINE.match(text, at, self.end)
            inside = _BLANKS.match(text, at, whole.end()).end()
            if inside < whole.end():
                if inside - at <= depth:
                    break
                begin = inside if begin is None else begin
                stop = inside + len(text[inside : whole.end()].rstrip())
            at = whole.end() + 1
        return None if begin is None else (begin, stop)


def region_spans(region: Region, threshold: float) -> dict[tuple[int, int], None]:
    """Literals of the definitions of one region whose target names, followed through other names, are sensitive."""
    text = region.text
    defs = sorted(region.given(), key=lambda d: d[1])
    places: dict[tuple[str, int], list[int]] = defaultdict(list)
    names = set()
    for k, (name, at, parts) in enumerate(defs):
        if parts:
            places[name, region.block(at)].append(k)
            names.add(name)
    nearest: dict[tuple[str, int], int] = {}

    def meant(name: str, at: int, own: int) -> int | None:
        """The definition that a name stands for: in the innermost block around it that has one, the last before it or the first after it."""
        if name not in names:
            return None
        bare, block = [], region.block(at)
        while block >= 0:
            block = nearest.get((name, block), block)
            if known := places.get((name, block), ()):
                nearest.update({(name, x): block for x in bare})
                bare, cut = [], bisect.bisect_left(known, own)
                if cut:
                    return known[cut - 1]
                if rest := [k for k in known[:2] if k != own]:
                    return rest[0]
            elif block >= 0:
                bare.append(block)
            block = region.around(block) if block >= 0 else -1
        nearest.update({(name, x): -1 for x in bare})
        return None

    refs: list[list[tuple]] = []
    for k, (_, _, parts) in enumerate(defs):
        made = []
        for kind, a, b in parts:
            if kind != "name":
                made.append((kind, a, b))
            elif (to := meant(text[a:b], a, k)) is not None:
                made.append(("def", to, to))
            elif len(parts) == 1 and name_score(defs[k][0]) >= SENSITIVE_NAME and any(c.isdigit() for c in text[a:b]):
                made.append(("bare", a, b))  # a bare word that nothing in the text is called
        refs.append(made)
    # From the most sensitive names on, each definition is reached once.
    reach = [0.0] * len(defs)
    for k in sorted(range(len(defs)), key=lambda k: -name_score(defs[k][0])):
        score = name_score(defs[k][0])
        if score < SENSITIVE_NAME:
            break
        todo = [k]
        while todo:
            now = todo.pop()
            if reach[now]:
                continue
            reach[now] = score
            todo += [to for kind, to, _ in refs[now] if kind == "def"]
    found: dict[tuple[int, int], None] = {}
    for k, made in enumerate(refs):
        if not reach[k] or not made:
            continue
        own = [(a, b) for kind, a, b in made if kind != "def"]
        if not own:
            continue
        counts = Counter()
        for a, b in own:
            counts.update(text[a:b])
        for kind, to, _ in made:
            for sort, a, b in refs[to] if kind == "def" else ():
                if sort != "def":
                    counts.update(text[a:b])
        value = text[own[0][0] : own[0][1]] if len(made) == 1 else ""
        good = 0.0 if PLACEHOLDER.match(value) else worth(counts)
        if not counts.keys().isdisjoint(" \n"):
            # Of several words one may be the secret: long, and of letters and digits.
            good = max([good, *[worth(Counter(w)) for w in value.split() if any(map(str.isdigit, w)) and any(map(str.isalpha, w))]])
        if reach[k] * good + 0.4 >= threshold:
            found |= {x: None for x in own if x[1] > x[0]}
    return found


def lexed_spans(text: str, threshold: float = 1.0) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the literals that the lexer finds; a text without a sensitive word has none."""
    if not may_name(text):
        return []
    found: dict[tuple[int, int], None] = {}
    todo = [(0, len(text), False)]
    while todo:
        region = Region(text, *todo.pop())
        found |= region_spans(region, threshold)
        todo += [x for x in region.inner if x[1] - x[0] >= 9 and may_name(text[x[0] : x[1]])]
    return sorted((a, 3, b) for a, b in found)


def scan(text: str) -> tuple:
    base = sorted(base_spans(text))
    added = sorted(base + lexed_spans(text)) if text else []
    said = lambda spans: ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)
    counts = [sum(k == i for _, k, _ in base) for i in range(3)]
    return *counts, hashlib.sha256(said(base).encode()).hexdigest(), said(added), len(added) - len(base)


def find_secrets(docs: DataFrame) -> DataFrame:
    """One row a document: counts of base spans, their digest, all spans, and the number the lexer added."""
    schema = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_lexed long"
    i, s = pa.int64(), pa.string()
    return map_texts(docs, scan, schema, ["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_lexed"], [i, i, i, s, s, i])


def redact(text: str, spans: str, mask: str = "[SECRET]") -> str:
    """The text with every span replaced."""
    cuts = sorted((int(s), int(e)) for _, s, e in (x.split(":") for x in spans.split(",") if x))
    out, at = [], 0
    for s, e in cuts:
        if e > at:
            out += [text[at : max(s, at)], mask if s >= at else ""]
            at = e
    return "".join(out) + text[at:]
