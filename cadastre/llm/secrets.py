"""Secret scans by grammar inference.

Base patterns find assignments, access keys and long hexadecimal strings. Beyond them,
formats are learnt from labelled credentials: what the base patterns find in the corpus itself, and
values of publicly documented formats. The credentials of a format, as symbols, make a prefix tree
with counts, whose states are merged wherever their continuations are statistically compatible
(a Hoeffding bound on every frequency). A symbol is a character where the format has few at that place, and
else stands for an open place, so that states tell places and lengths apart; what may stand at open places is
learnt as transitions between classes of characters, and characters within a class. The
result is a small probabilistic automaton. Ordinary text is learnt too, from long runs of the corpus
that no base pattern finds; so that encoded text and identifiers are not taken for keys, it also explains runs
that decode to text, and universally unique identifiers. Every other long run of letters, digits and the marks of encodings is a candidate, whole
or what base spans leave of it, and is a find if some format explains it by ``BITS`` bits or more better than ordinary text does.
"""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_scratch, materialise, sliced, table

#: Fixed values of the contract: the base patterns and the order of kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "format")
MARKS = ("passw", "secret", "token", "api")

SHORTEST = 20
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
END = ""
BITS = 25.0
SAMPLES, SEED = 80, 7

Span = tuple[int, int, int]


def base_spans(text: str) -> list[Span]:
    """(start, kind, end) in code points by start, then kind."""
    found: list[Span] = []
    low = text.lower()
    if any(m in low for m in MARKS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    # A run of 24 or more is the same whether short runs are matched first or skipped.
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def labelled_formats(samples: int = SAMPLES, seed: int = SEED) -> list[tuple[str, str]]:
    """Labelled credentials (format, value) in publicly documented formats, drawn by rule."""
    draw = random.Random(seed)
    upper, lower, digits = ALPHABET[:26], ALPHABET[26:52], ALPHABET[52:62]
    word = upper + lower + digits

    def some(n: int, of: str) -> str:
        return "".join(draw.choice(of) for _ in range(n))

    rules = {
        "aws-secret": lambda: some(40, word + "+/"),
        "github": lambda: draw.choice(["ghp_", "gho_", "ghs_"]) + some(36, word),
        "slack": lambda: "xoxb-" + some(12, digits) + "-" + some(12, digits) + "-" + some(24, word),
        "google": lambda: "AIza" + some(35, word + "_-"),
        "stripe": lambda: draw.choice(["sk_live_", "rk_live_"]) + some(24, word),
        "npm": lambda: "npm_" + some(36, word),
        "base64-block": lambda: some(draw.randint(60, 300), word + "+/"),
        "upper-hex": lambda: some(draw.choice([32, 40, 64]), digits + "ABCDEF"),
    }
    return [(name, rule()) for name, rule in rules.items() for _ in range(samples)]


def class_of(c: str) -> str:
    return "a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else "-" if c else ""


#: Classes of characters, "" at the start, and how many characters of the alphabet each has.
CLASSES = ("", "a", "A", "0", "-")
WIDE = {k: sum(class_of(c) == k for c in ALPHABET) for k in CLASSES}

#: Distinct characters up to which a place of a format is literal, and the symbol of any other place.
LITERAL, ANY = 3, "any"


class FormatAutomaton:
    """A probabilistic automaton from examples: prefix tree, then compatible states merged."""

    def __init__(self, values: Iterable[str], alpha: float = 0.05):
        values = list(values)
        seen: list[set[str]] = []
        for value in values:
            seen += [set() for _ in range(len(value) - len(seen))]
            for place, c in enumerate(value):
                seen[place].add(c)
        self.literal = [s if len(s) <= LITERAL else frozenset() for s in seen]
        steps: dict[tuple[str, str], int] = defaultdict(int)
        befores: dict[str, int] = defaultdict(int)
        inside: dict[str, int] = defaultdict(int)
        classes: dict[str, int] = defaultdict(int)
        for value in values:
            for before, c, symbol in zip(["", *value], value, self.symbols(value), strict=False):
                if symbol == ANY:
                    was, now = class_of(before), class_of(c)
                    steps[was, now] += 1
                    befores[was] += 1
                    inside[c] += 1
                    classes[now] += 1
        # A character at an open place after another: its class after the other's, then itself in its class; a little of each for what was never seen.
        self.open = {}
        for was in CLASSES:
            for c in ALPHABET:
                now = class_of(c)
                step = (steps[was, now] + 2 * classes[now] / max(1, sum(classes.values())) + 0.02) / (befores[was] + 2 + 0.02 * len(CLASSES))
                itself = (inside[c] + 0.5 / WIDE[now]) / (classes[now] + 0.5)
                self.open[was, c] = -math.log2(step) - math.log2(itself)
        self.out: list[dict[str, int]] = [{}]
        self.count: list[dict[str, int]] = [defaultdict(int)]
        self.total = [0]
        for value in values:
            state = 0
            for symbol in [*self.symbols(value), END]:
                self.total[state] += 1
                self.count[state][symbol] += 1
                if symbol != END:
                    if symbol not in self.out[state]:
                        self.out.append({})
                        self.count.append(defaultdict(int))
                        self.total.append(0)
                        self.out[state][symbol] = len(self.out) - 1
                    state = self.out[state][symbol]
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        self.merge_all()
        self.finish()

    def symbols(self, value: str) -> list[str]:
        places = len(self.literal)
        return [c if k < places and c in self.literal[k] else ANY for k, c in enumerate(value)]

    def differ(self, a: int, b: int, symbol: str) -> bool:
        m, n = self.total[a], self.total[b]
        return abs(self.count[a].get(symbol, 0) / m - self.count[b].get(symbol, 0) / n) > self.bound * (1 / math.sqrt(m) + 1 / math.sqrt(n))

    def compatible(self, a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            if a == b or not self.total[a] or not self.total[b]:
                continue
            if any(self.differ(a, b, s) for s in self.count[a].keys() | self.count[b].keys()):
                return False
            todo += [(self.out[a][s], self.out[b][s]) for s in self.out[a].keys() & self.out[b].keys()]
        return True

    def fold(self, a: int, b: int) -> None:
        """The subtree of ``b`` into ``a``."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            self.total[a] += self.total[b]
            for s, n in self.count[b].items():
                self.count[a][s] += n
            for s, there in self.out[b].items():
                if s in self.out[a]:
                    todo.append((self.out[a][s], there))
                else:
                    self.out[a][s] = there

    def merge_all(self) -> None:
        kept = [0]
        while True:
            inside = set(kept)
            fringe = sorted({(-self.total[t], t, p, s) for p in kept for s, t in self.out[p].items() if t not in inside})
            if not fringe:
                self.states = kept
                return
            _, new, parent, symbol = fringe[0]
            for old in kept:
                if self.compatible(old, new):
                    self.out[parent][symbol] = old
                    self.fold(old, new)
                    break
            else:
                kept.append(new)

    def finish(self) -> None:
        """Costs in bits by state and symbol; what a state lacks costs as one in all it has seen."""
        self.cost = [{} for _ in self.out]
        self.lacking = [0.0 for _ in self.out]
        self.usual: list[int | None] = [None for _ in self.out]
        for s in self.states:
            whole = self.total[s] + 1.0
            self.cost[s] = {symbol: -math.log2(n / whole) for symbol, n in self.count[s].items()}
            self.lacking[s] = -math.log2(1.0 / whole / (len(ALPHABET) + 2))
            if self.out[s]:
                self.usual[s] = self.out[s][max(self.out[s], key=lambda c: (self.count[s][c], c))]

    def bits(self, value: str) -> float:
        """Information of ``value`` and its end under this format."""
        state, total = 0, 0.0
        for before, c, symbol in zip(["", *value], value, self.symbols(value), strict=False):
            cost = self.cost[state].get(symbol)
            total += self.lacking[state] if cost is None else cost
            if symbol == ANY:
                total += self.open[class_of(before), c]
            there = self.out[state].get(symbol, self.usual[state])
            state = state if there is None else there
        # An end where no example ends counts twice: lengths are part of a format.
        return total + self.cost[state].get(END, 2 * self.lacking[state])


#: What is believed of ordinary text beforehand: bits for a symbol by its class, given the class before; runs of one class are usual.
SAME, OTHER = -math.log2(0.94), -math.log2(0.02)
WITHIN = {"a": math.log2(16), "A": math.log2(20), "0": math.log2(10), "-": math.log2(5)}
#: As many observations of a character after another as that belief counts for.
BELIEF = 200.0


def believed_bits(before: str, c: str) -> float:
    now = class_of(c)
    return WITHIN[now] + (2.0 if not before else SAME if now == class_of(before) else OTHER)


class Ordinary:
    """Characters after one another in ordinary long runs, as observed, on top of what is believed beforehand."""

    def __init__(self, runs: Iterable[str] = ()):
        pairs: dict[tuple[str, str], int] = defaultdict(int)
        firsts: dict[str, int] = defaultdict(int)
        for run in runs:
            for before, c in zip(["", *run], run, strict=False):
                pairs[before, c] += 1
                firsts[before] += 1
        self.cost = {}
        for before in ["", *ALPHABET]:
            for c in ALPHABET:
                share = 2 ** -believed_bits(before, c)
                self.cost[before, c] = -math.log2((pairs[before, c] + BELIEF * share) / (firsts[before] + BELIEF))

    def bits(self, value: str) -> float:
        """Of what explains a run as ordinary, the shortest: characters one after another, an identifier, or text in an encoding."""
        found = 4.0 + sum(map(self.cost.__getitem__, zip(["", *value], value, strict=False)))
        if UUID.fullmatch(value):
            return min(found, 8.0 + 4.0 * 32)
        return min(found, 6.0 + word_bits(value), *(8.0 + text_bits(raw) for raw in decoded(value)))


#: Percent of letters in running text.
LETTERS = {
    "a": 8.2, "b": 1.5, "c": 2.8, "d": 4.3, "e": 12.7, "f": 2.2, "g": 2.0, "h": 6.1, "i": 7.0, "j": 0.15, "k": 0.77, "l": 4.0, "m": 2.4,
    "n": 6.7, "o": 7.5, "p": 1.9, "q": 0.1, "r": 6.0, "s": 6.3, "t": 9.1, "u": 2.8, "v": 0.98, "w": 2.4, "x": 0.15, "y": 2.0, "z": 0.07,
}
#: Bits of a letter of a word, languages differing by a fifth; and of words that begin with capitals: small after small, capital after small, and so on.
LETTER_BITS = {c: -math.log2(0.8 * p / 100 + 0.2 / 26) for c, p in LETTERS.items()}
CASE_BITS = {("a", "a"): 0.25, ("a", "A"): 2.7, ("A", "a"): 0.15, ("A", "A"): 3.4}


def word_bits(value: str) -> float:
    """Of words set together, each with a capital or none."""
    total, was = 0.0, ""
    for c in value:
        now, letter = class_of(c), LETTER_BITS.get(c.lower())
        total += WITHIN[now] + (SAME if now == was else OTHER) if letter is None else letter + CASE_BITS.get((was, now), OTHER if was in ("0", "-") else 1.0)
        was = now
    return total


#: Fixed value: the shape of universally unique identifiers.
UUID = re.compile(r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}")


def decoded(value: str) -> Iterator[bytes]:
    """What a run is in hexadecimal digits or in base64, if it is whole in one of them."""
    if len(value) % 2 == 0 and re.fullmatch("[0-9a-f]+|[0-9A-F]+", value):
        yield bytes.fromhex(value)
    bare = value.rstrip("=")
    if len(value) - len(bare) <= 2 and len(bare) % 4 != 1 and "=" not in bare:
        yield base64.urlsafe_b64decode(bare.replace("+", "-").replace("/", "_") + "=" * (-len(bare) % 4))


#: What is believed of bytes of text: bits for one by its class, less where it goes on as before; a byte of no text costs more than a random one.
TEXT_BITS = {"a": 4.4, "A": 6.5, "0": 4.8, " ": 2.7, ".": 6.5, "é": 7.0, "?": 20.0}


def text_class(b: int) -> str:
    c = chr(b)
    return "é" if b >= 0x80 else "a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else " " if c in " \n" else "." if 32 < b < 127 or c in "\t\r" else "?"


TEXT_CLASSES = [text_class(b) for b in range(256)]


def text_bits(raw: bytes) -> float:
    """Information of bytes read as text; bytes beyond ASCII count as text only where all is UTF-8."""
    try:
        raw.decode()
        wrong = 0.0
    except UnicodeDecodeError:
        wrong = 13.0
    classes = [TEXT_CLASSES[b] for b in raw]
    same = sum(x == y != "?" for x, y in zip(classes, classes[1:], strict=False))
    return sum(TEXT_BITS[k] + (wrong if k == "é" else 0.0) for k in classes) - 0.2 * same


class Formats:
    def __init__(self, labelled: list[tuple[str, str]], ordinary: Iterable[str] = ()):
        by: dict[str, list[str]] = defaultdict(list)
        for name, value in labelled:
            by[name].append(value)
        self.automata = {name: FormatAutomaton(values) for name, values in sorted(by.items())}
        self.ordinary = Ordinary(ordinary)

    def gain(self, value: str) -> tuple[float, str]:
        """Bits by which the best format explains ``value`` better than ordinary text, and its name."""
        best, name = min(((a.bits(value), n) for n, a in self.automata.items()), default=(math.inf, ""))
        return self.ordinary.bits(value) - best, name

    def spans(self, text: str, base: list[Span], bits: float) -> list[Span]:
        return [(a, 3, b) for a, b in candidates(text, base) if self.gain(text[a:b])[0] >= bits]


def candidates(text: str, base: list[Span]) -> Iterator[tuple[int, int]]:
    """Runs of at least ``SHORTEST`` characters, and what ``base`` spans leave of others that is so long."""
    taken = sorted((a, b) for a, _, b in base)
    k = 0
    for m in CANDIDATE.finditer(text):
        low, end = m.span()
        while k < len(taken) and taken[k][1] <= low:
            k += 1
        at = k
        while at < len(taken) and taken[at][0] < end:
            a, b = taken[at]
            if a - low >= SHORTEST:
                yield low, a
            low = max(low, b)
            at += 1
        if end - low >= SHORTEST:
            yield low, end


@cache
def default_formats() -> Formats:
    return Formats(labelled_formats())


def span_text(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


FOUND = {"base": "array<struct<start:long,kind:int,stop:long>>", "added": "array<struct<start:long,kind:int,stop:long>>"}


#: Values of each kind, and ordinary runs, that are learnt from at most: those of the smallest hashes.
LEARNT = 400
ORDINARY = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{12,}(?![A-Za-z0-9+/_=-])")


def mixed_run(value: str) -> bool:
    return any(map(str.isdigit, value)) and any(map(str.isalpha, value))


def teachers(text: str) -> Iterator[tuple[str, str]]:
    """(kind, value) of what the base patterns find, and (``ordinary``, run) of other long runs of a text."""
    base = base_spans(text)
    for start, kind, stop in base:
        value = ASSIGN.match(text, start)[2] if kind == 0 else text[start:stop]
        # A password that is a word teaches nothing about formats.
        if kind or (len(value) >= 16 and mixed_run(value)):
            yield f"corpus-{KINDS[kind]}", "".join(c for c in value if c in ALPHABET)
    for m in ORDINARY.finditer(text):
        if not any(a < m.end() and m.start() < b for a, _, b in base):
            yield "ordinary", m[0]


def learn(docs: DataFrame, *, most: int = LEARNT) -> tuple[list[tuple[str, str]], list[str]]:
    """Labelled credentials and ordinary runs of ``docs``, ``most`` of each kind: those of the smallest hashes, equal ones once.

    Runs that public formats explain far better than what is believed beforehand teach nothing about ordinary text.
    Any number of values teaches a format; a few are places of few characters, so that little else is like them. An empty
    table teaches nothing, and public formats stand alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The smallest of a task are all that can be among the smallest of all.
        held: dict[str, dict[str, int]] = defaultdict(dict)
        for batch in batches:
            for text in batch.column(0):
                for kind, value in teachers(text.as_py() or ""):
                    own = held[kind]
                    own[value] = int.from_bytes(hashlib.blake2b(value.encode(), digest_size=7).digest())
                    if len(own) >= 4 * most:
                        held[kind] = dict(sorted(own.items(), key=lambda x: x[1])[:most])
        rows = [(kind, value, h) for kind, own in held.items() for value, h in sorted(own.items(), key=lambda x: x[1])[:most]]
        if rows:
            kinds = [pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["kind", "value", "place"])

    found = materialise(docs.select("text").mapInArrow(run, "kind string, value string, place long"), "secret-teachers")
    out = {}
    for kind in (*[f"corpus-{k}" for k in KINDS[:3]], "ordinary"):
        rows = found.where(F.col("kind") == kind).groupBy("value").agg(F.min("place").alias("place")).orderBy("place", "value").limit(most).collect()
        out[kind] = [r["value"] for r in rows]
    drop_scratch(found)
    known = default_formats()
    ordinary = [v for v in out.pop("ordinary") if known.gain(v)[0] < BITS]
    return [(kind, v) for kind, values in out.items() for v in values], ordinary


def learnt_formats(docs: DataFrame) -> Formats:
    """Formats of the corpus and public ones, against the corpus's ordinary runs."""
    labelled, ordinary = learn(docs)
    return Formats([*labelled_formats(), *labelled], ordinary)


Scanner = Callable[[str], tuple[list[Span], list[Span]]]


def scanner(formats: Formats, bits: float) -> Scanner:
    def scan(text: str) -> tuple[list[Span], list[Span]]:
        base = base_spans(text)
        return base, formats.spans(text, base, bits)

    return scan


def find(docs: DataFrame, *, formats: Formats | None = None, bits: float = BITS) -> DataFrame:
    """``docs`` with ``base`` and ``added``: spans (start, kind number, stop) in code points of the whole text.

    A null or empty text has none. Rows are independent, other columns pass through.
    ``formats``: what to look for; None: what ``learnt_formats`` learns from ``docs``. A run is scored whole, however long.
    """
    formats = formats or learnt_formats(docs)
    names = docs.columns
    schema = docs.withColumns({n: F.lit(None).cast(t) for n, t in FOUND.items()}).schema
    order = [f.name for f in schema.fields]
    kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("stop", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(formats, bits)
        as_rows = lambda spans: [{"start": a, "kind": k, "stop": b} for a, k, b in spans]
        for batch in sliced(batches):
            found = [scan(text or "") for text in batch.column(names.index("text")).to_pylist()]
            made = {"base": pa.array([as_rows(b) for b, _ in found], kind), "added": pa.array([as_rows(a) for _, a in found], kind)}
            yield pa.RecordBatch.from_arrays([made[n] if n in made else batch.column(names.index(n)) for n in order], names=order)

    return docs.mapInArrow(run, schema)


def joined(spans: Column) -> Column:
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat(F.get(name, s["kind"]), F.lit(":"), s["start"].cast("string"), F.lit(":"), s["stop"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.concat("base", "added")).alias("spans"))


def redacted(text: str, spans: list[Span], mark: str) -> str:
    parts, low = [], 0
    for a, _, b in sorted(spans):
        if a >= low:
            parts += [text[low:a], mark]
        low = max(low, b)
    return "".join([*parts, text[low:]])


def redact(docs: DataFrame, *, mark: str = "[secret]", formats: Formats | None = None, bits: float = BITS) -> DataFrame:
    """``docs``, columns as given, with every found span of ``text`` replaced by ``mark``; overlapping spans by one."""
    kept, formats = docs.columns, formats or learnt_formats(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(formats, bits)
        for batch in sliced(batches):
            at, texts = kept.index("text"), []
            for text in batch.column(at).to_pylist():
                base, added = scan(text or "")
                texts.append(redacted(text, base + added, mark) if base or added else text)
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if k == at else c for k, c in enumerate(batch.columns)], names=kept)

    return docs.mapInArrow(run, docs.schema)


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(find(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op6_brute_force(text: str | None) -> tuple[int, int, int, str]:
    """The base columns by the contract's patterns as they are written, failing matches dropped."""
    text, found = text or "", []
    for kind, pattern, least in ((0, ASSIGN, 6), (1, ACCESS, 20), (2, re.compile("[0-9a-f]+"), 24)):
        found += [(m.start(), kind, m.end()) for m in pattern.finditer(text) if len(m[2] if kind == 0 else m[0]) >= least]
    digest = hashlib.sha256(span_text(found).encode()).hexdigest()
    return tuple(sum(k == n for _, k, _ in found) for n in range(3)) + (digest,)
