"""Secret scans: plain patterns, and literals that source or configuration assigns to names of secrets."""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lintel.llm.common import whole_text

KINDS = ("assign", "access", "hex")
# The three plain patterns; a match that is too short is dropped and not looked into again.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
LEAST = {"assign": 6, "access": 20, "hex": 24}


@dataclass(frozen=True)
class Finding:
    """A span of the text (code points, end exclusive): its kind, the name it was assigned to, a score from 0 to 1, and whether a plain pattern has it."""

    start: int
    stop: int
    kind: str
    name: str | None
    score: float
    base: bool


def plain_findings(text: str) -> list[Finding]:
    """What the three plain patterns find: per kind leftmost, not overlapping, failing matches dropped."""
    out = [Finding(m.start(), m.end(), "assign", m[1], 1.0, True) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [Finding(m.start(), m.end(), "access", None, 1.0, True) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    return out + [Finding(m.start(), m.end(), "hex", None, 1.0, True) for m in HEX.finditer(text)]


# Words of names, and how surely a name with such a word holds a secret.
WORDS = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "passcode": 0.9, "pwd": 0.9, "pass": 0.8, "secret": 1.0, "secrets": 0.9,
    "token": 0.9, "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "creds": 0.9, "bearer": 0.9, "authorization": 0.8, "auth": 0.6,
    "salt": 0.6, "pin": 0.6, "cookie": 0.6, "passwort": 1.0, "kennwort": 1.0, "contraseña": 1.0, "clave": 0.7, "motdepasse": 1.0,
}
# Words that make a key a secret one.
KEY_WORDS = {"api": 1.0, "access": 0.9, "private": 1.0, "secret": 1.0, "signing": 1.0, "encryption": 1.0, "master": 0.8, "client": 0.7, "account": 0.8, "service": 0.7, "shared": 0.8, "ssh": 0.8}
# Words after which a name holds something about the secret and not the secret.
ABOUT = {"hint", "label", "field", "name", "url", "uri", "path", "file", "prompt", "length", "policy", "type", "count", "max", "min", "expires", "expiry", "ttl", "public", "placeholder", "regex", "format", "header", "prefix", "endpoint", "help", "message", "error"}
# Literals that stand for a secret to be filled in.
PLACEHOLDERS = {"changeme", "password", "secret", "token", "example", "placeholder", "undefined", "required", "optional", "string", "redacted", "default", "yourpassword", "yoursecret", "yourtoken", "yourapikey"}
STEM = re.compile(r"pass|pwd|secret|token|key|cred|bearer|auth|salt|pin|cookie|kennwort|contrase|clave", re.IGNORECASE)
SCORE = 0.5
_NAME = re.compile(r"[A-Za-z]+(?:[_.-][A-Za-z]+)*")
_SPLIT = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[^\W\d_A-Z]+|\d+")


def name_score(name: str) -> float:
    """How surely the target name means a secret: its words, split at signs and at changes of case."""
    words = [w.lower() for w in _SPLIT.findall(name)]
    if not words:
        return 0.0
    together = "".join(words)
    best = max((WORDS.get(w, 0.0) for w in [*words, together]), default=0.0)
    for i, w in enumerate(words):
        if w in ("key", "keys", "schlüssel") and i:
            best = max(best, KEY_WORDS.get(words[i - 1], 0.0))
    return best * 0.3 if words[-1] in ABOUT or words[0] in ("public", "is", "has", "no") else best


def literal_score(value: str, quoted: bool) -> float:
    """How much a literal looks like a secret: length, kinds of characters, entropy; 0 for what is to be filled in."""
    bare = re.sub(r"[^a-z]", "", value.lower())
    if len(value) < LEAST["assign"] or len(set(value)) < 4 or bare in PLACEHOLDERS or value.startswith(("$", "<", "{{", "%(")):
        return 0.0
    if value.isupper() and _NAME.fullmatch(value):
        return 0.2  # the name of another setting
    if any(c.isspace() for c in value):
        return 0.3 if quoted else 0.0
    digit, letter = any(c.isdigit() for c in value), any(c.isalpha() for c in value)
    signs = any(not c.isalnum() for c in value)
    counts = Counter(value)
    entropy = -sum(n / len(value) * math.log2(n / len(value)) for n in counts.values())
    if digit and letter and (entropy >= 3 or signs):
        return 1.0
    if digit and letter or signs and letter and quoted:
        return 0.8
    return 0.7 if quoted else 0.2


#: Tokens of source and configuration. An escape outside a string is one token, so that a quote without an end is tried once a line.
TOKEN = re.compile(
    r"""(?P<nl>\n)|(?P<space>[^\S\n]+)
    |(?P<string>(?:(?<!\w)[rRbBfFuU]{1,2})?(?:\"\"\"(?s:\\.|[^\\])*?\"\"\"|'''(?s:\\.|[^\\])*?'''|"(?:\\.|[^"\\\n])*+"|(?<!\w)'(?:\\.|[^'\\\n])*+'|(?<=[rRbBfFuU])'(?:\\.|[^'\\\n])*+'|`(?:\\.|[^`\\\n])*+`))
    |(?P<escape>\\(?s:.))|(?P<op>:=|=>|->|==|!=|<=|>=|\+=|\.=|\|\||&&|\?\?|[=:+,;(){}\[\]<>?|.&])
    |(?P<word>--?[A-Za-z][\w-]*|[$@%]?[^\W\d][\w$]*(?:[.-][^\W\d][\w$]*)*)|(?P<other>[^\s=:+,;(){}\[\]<>?|.&"'`\\]+|.)""",
    re.VERBOSE,
)
_QUOTE = re.compile(r"""[rRbBfFuU]{0,2}(\"\"\"|'''|["'`])""")
#: References within a string: ${name}, $name, #{name}, {name}, %(name)s.
REFERENCE = re.compile(r"[$#]?\{\s*([^\W\d][\w.]*)\s*\}|\$([^\W\d]\w*)|%\(([^\W\d]\w*)\)s")
#: A value without quotes: up to a blank, a comma, a bracket, or a sign that assigns something in quotes.
BARE = re.compile(r"""(?:[^\s"'`,;(){}\[\]<>=:]|[=:]+(?=[^\s"'`,;(){}\[\]<>=:]))+(?:={1,2}(?=[\s,;)}\]]|\Z))?""")
XML = re.compile(r"<([^\W\d][\w.-]*)>([^<>\n]+)</\1>")
KEY_VALUE = re.compile(r"""(?:key|name|id)\s*=\s*(["'])([^"'\n]+)\1\s+value\s*=\s*(["'])([^"'\n]+)\3""", re.IGNORECASE)
STOPS = {",", ";", "}", "]", ")"}
SIGNS = {"=", ":", ":=", "=>", "+="}
#: Words of expressions that are no names of constants.
NO_NAMES = {"or", "and", "if", "else", "new", "await", "return", "not"}
ENDS = {"(": ")", "[": "]", "{": "}"}
OPENS = {v: k for k, v in ENDS.items()}
#: Calls within calls of a value that are looked into.
DEEP = 4


@dataclass(frozen=True)
class Piece:
    """A literal in the text, with the references that it holds as holes, or a reference to a name."""

    start: int
    stop: int
    quoted: bool = True
    refers: str | None = None
    holes: tuple[tuple[int, int], ...] = ()

    def of(self, text: str) -> str:
        """The literal without its holes."""
        out, at = [], self.start
        for a, b in self.holes:
            out.append(text[at:a])
            at = b
        return "".join([*out, text[at : self.stop]])


@dataclass
class Binding:
    """A name and the alternatives of its value, each a run of pieces that are joined."""

    name: str
    at: int
    values: list[list[Piece]] = field(default_factory=list)


class Tokens:
    """The tokens of a stretch of text, blanks left out, and for every opening bracket the place of the one that closes it."""

    def __init__(self, text: str, start: int, stop: int):
        self.text, self.stop = text, stop
        self.all = [(m.lastgroup, m.start(), m.end()) for m in TOKEN.finditer(text, start, stop) if m.lastgroup != "space" and m[0] != "\\\n"]
        self.closing: dict[int, int] = {}
        waiting: dict[str, list[int]] = {"(": [], "[": [], "{": []}
        for i, (kind, _, _) in enumerate(self.all):
            if kind == "op":
                said = self.said(i)
                if said in ENDS:
                    waiting[said].append(i)
                elif said in OPENS and waiting[OPENS[said]]:
                    self.closing[waiting[OPENS[said]].pop()] = i

    def __len__(self) -> int:
        return len(self.all)

    def kind(self, i: int) -> str:
        return self.all[i][0] if 0 <= i < len(self.all) else "nl"

    def said(self, i: int) -> str:
        return self.text[self.all[i][1] : self.all[i][2]] if 0 <= i < len(self.all) else "\n"


def _inside(text: str, start: int, stop: int) -> tuple[int, int]:
    """The span between the quotes of a string token."""
    m = _QUOTE.match(text, start)
    return m.end(), stop - len(m[1])


def bindings(text: str) -> list[Binding]:
    """Name-literal and name-reference pairs of source, configuration, markup and command lines, in the order of the text.

    Understood are name = value, name: value, name := value, name => value, quoted names, subscripts (env["name"] = value), type annotations,
    --name value, <name>value</name>, key="name" value="value", and assignments within strings.
    """
    found = [Binding(m[1], m.start(), [[Piece(m.start(2), m.end(2))]]) for m in XML.finditer(text)]
    found += [Binding(m[2], m.start(), [[Piece(m.start(4), m.end(4))]]) for m in KEY_VALUE.finditer(text)]
    todo = [(0, len(text))]
    while todo:
        tokens = Tokens(text, *todo.pop())
        after = 0  # tokens before this one are part of a bare value
        for i, (kind, a, b) in enumerate(tokens.all):
            if kind == "string":
                inner = _inside(text, a, b)
                if any(c in text[inner[0] : inner[1]] for c in "=:"):
                    todo.append(inner)
            if i < after:
                continue
            if kind == "op" and text[a:b] in SIGNS:
                name = _target(tokens, i)
                values, after = _values(tokens, i + 1) if name else ([], 0)
            elif kind == "word" and text.startswith("--", a) and tokens.kind(i + 1) in ("string", "word", "other") and not tokens.said(i + 1).startswith("-"):
                name = text[a:b].lstrip("-")
                piece, _ = _operand(tokens, i + 1)
                values = [piece]
            else:
                continue
            if name and values:
                found.append(Binding(name, a, values))
    return sorted(found, key=lambda x: x.at)


def _target(tokens: Tokens, i: int) -> str | None:
    """The name that the sign at token i assigns to."""
    j = i - 1
    if tokens.said(i) == "=" and tokens.kind(j) == "word" and tokens.said(j - 1) in (":", "->"):
        j -= 2  # name: type = value
    while j >= 0 and tokens.said(j) in ("]", ")"):
        j -= 1
    if j < 0 or tokens.kind(j) not in ("string", "word"):
        return None
    kind, a, b = tokens.all[j]
    if kind == "string":
        a, b = _inside(tokens.text, a, b)
    return tokens.text[a:b].lstrip("-$@%")


def _operand(tokens: Tokens, i: int) -> tuple[list[Piece], int]:
    """The pieces of a string or of a bare value, and the token after them."""
    kind, a, b = tokens.all[i]
    text = tokens.text
    if kind == "string":
        lo, hi = _inside(text, a, b)
        inner = list(REFERENCE.finditer(text, lo, hi))
        refers = [Piece(m.start(), m.end(), refers=next(g for g in m.groups() if g)) for m in inner]
        return [Piece(lo, hi, holes=tuple(m.span() for m in inner)), *refers], i + 1
    m = REFERENCE.match(text, a, tokens.stop) or BARE.match(text, a, tokens.stop)
    end = m.end() if m else b
    name = text[a:b].lstrip("$@%") if kind == "word" and end == b else None
    if m and m.re is REFERENCE:
        name = next(g for g in m.groups() if g)
    while i < len(tokens) and tokens.all[i][1] < end:
        i += 1
    return [Piece(a, end, False, refers=name)], i


def _values(tokens: Tokens, i: int) -> tuple[list[list[Piece]], int]:
    """The alternatives of the value that begins at token i, up to the end of its statement, and the token after a bare value.

    Strings that touch or are joined by a plus, a dot or an ampersand are one value; arguments of a call, and what `or` and its kin
    part, are alternatives of their own. References are names that stand alone or within a string.
    """
    if tokens.kind(i) == "nl" and tokens.kind(i + 1) == "string":
        i += 1  # a string may begin on the line after its sign
    first_is_bare = tokens.kind(i) in ("word", "other", "escape") and tokens.said(i + 1) not in ("(", ".")
    runs: list[list[Piece]] = [[]]
    after = 0
    if first_is_bare:
        runs[0], i = _operand(tokens, i)
        after = i
    joined, choice = not first_is_bare, False
    ends: list[int] = []  # places where the brackets around end
    while i < len(tokens):
        kind, said = tokens.kind(i), tokens.said(i)
        if kind == "nl":
            if not ends and tokens.said(i + 1) not in ("+", ".", "||"):
                break
        elif kind == "string":
            if not joined:
                runs.append([])
            pieces, _ = _operand(tokens, i)
            runs[-1] += pieces
            joined = True
        elif kind == "op":
            if ends and i == ends[-1]:
                ends.pop()
                joined = False
            elif said in ENDS:
                if said == "{" and not ends or i not in tokens.closing:
                    break  # a block or a map, whose entries are pairs of their own, or a bracket without an end
                if len(ends) < DEEP:
                    ends.append(tokens.closing[i])
                else:
                    i = tokens.closing[i]
                joined = False
            elif not ends and (said in STOPS or said in SIGNS and not (choice and said == ":")):
                break
            elif said in SIGNS:
                joined = False
                if ends and runs[-1] and runs[-1][-1].refers:
                    runs[-1].pop()  # the name of a keyword argument
            else:
                joined = said in ("+", ".", "&")
                choice = choice or said == "?"
        elif kind == "word" and tokens.said(i + 1) != "(" and said not in NO_NAMES:
            if not joined:
                runs.append([])
            _, a, b = tokens.all[i]
            runs[-1].append(Piece(a, b, False, refers=said.lstrip("$@%")))
            joined = False
        else:
            joined = False
        i += 1
    return [run for run in runs if run], after


class Constants:
    """What the names of one text stand for."""

    def __init__(self, text: str, found: list[Binding]):
        self.text, self.found = text, found
        self.of: dict[str, tuple[list[int], list[int]]] = {}
        for i, b in enumerate(found):
            places, numbers = self.of.setdefault(b.name.rpartition(".")[2], ([], []))
            places.append(b.at)
            numbers.append(i)

    def meant(self, name: str, at: int) -> int | None:
        """The last binding of the name before a place, else the first one after it."""
        places, numbers = self.of.get(name.rpartition(".")[2], ((), ()))
        return numbers[max(0, bisect_left(places, at) - 1)] if numbers else None

    def literals(self, run: list[Piece], at: int) -> list[Piece]:
        """The literals that a run of pieces stands for, references followed to the end; each literal and binding once.

        Of the alternatives of a referred binding the last one counts, as defaults come last.
        """
        out, seen = [], set()
        todo = [(piece, at) for piece in reversed(run)]
        while todo:
            piece, place = todo.pop()
            if piece.refers is not None:
                i = self.meant(piece.refers, place)
                if i is not None:
                    if i not in seen:
                        seen.add(i)
                        b = self.found[i]
                        todo += [(p, b.at) for p in reversed(b.values[-1])]
                    continue
                if piece.quoted or not self.text[piece.start].isalnum():
                    continue  # an unknown name that is marked as one says nothing
            out.append(Piece(piece.start, piece.stop, piece.quoted, holes=piece.holes))
        return list(dict.fromkeys(out))


def assigned_findings(text: str) -> list[Finding]:
    """Literals that reach a name of a secret, straight or by way of constants, whose name and literal score SCORE together at least."""
    if STEM.search(text) is None:
        return []  # no name can score
    found = bindings(text)
    known = Constants(text, found)
    best: dict[tuple[int, int], Finding] = {}
    for b in found:
        name = name_score(b.name)
        if name < SCORE:
            continue
        for run in b.values:
            pieces = known.literals(run, b.at)
            value = "".join(p.of(text) for p in pieces)
            score = name * literal_score(value, all(p.quoted for p in pieces))
            if score < SCORE:
                continue
            for p in pieces:
                if len(p.of(text)) >= (LEAST["assign"] if p.holes else 1) and score > best.get((p.start, p.stop), Finding(0, 0, "", None, 0.0, False)).score:
                    best[p.start, p.stop] = Finding(p.start, p.stop, "assign", b.name, round(score, 6), False)
    return list(best.values())


def all_findings(text: str) -> list[Finding]:
    """Plain findings, and assigned literals that overlap none of them nor each other, by start and then kind."""
    base = plain_findings(text)
    starts: list[int] = []  # of the stretches that plain findings cover
    stops: list[int] = []
    for f in sorted(base, key=lambda f: f.start):
        if stops and f.start <= stops[-1]:
            stops[-1] = max(stops[-1], f.stop)
        else:
            starts.append(f.start)
            stops.append(f.stop)
    out, end = list(base), 0
    for f in sorted(assigned_findings(text), key=lambda f: (f.start, -f.stop)):
        i = bisect_left(starts, f.stop) - 1  # the last stretch that begins before f ends
        if f.start >= end and (i < 0 or stops[i] <= f.start):
            out.append(f)
            end = f.stop
    return sorted(out, key=lambda f: (f.start, KINDS.index(f.kind), f.stop))


FINDINGS = "array<struct<start:bigint,stop:bigint,kind:string,name:string,score:double,base:boolean>>"


def find_secrets(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id and findings, an array of (start, stop, kind, name, score, base) by start and then kind.

    Plain findings (base) are what the three patterns match. Added to them are literals that source or configuration in the text assigns to
    a name of a secret, straight or through constants, strings joined and references in strings included; kind assign, with the target's name and
    the score. Added findings overlap no plain one. Whole texts are read; null counts as empty and has no findings. Repeated rows each
    get a row; an empty table gives an empty one; other columns are not looked at. No shuffle; a text is the unit of work, and time grows with its length.
    """

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("kind", pa.string()), ("name", pa.string()), ("score", pa.float64()), ("base", pa.bool_())]))
        for batch in given:
            found = [[vars(f) for f in all_findings(t)] for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found, kind)], ["doc_id", "findings"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(batches, f"doc_id bigint, findings {FINDINGS}")


def shown(findings: Column) -> Column:
    """kind:start:end of all findings, joined by commas."""
    return F.array_join(F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["stop"].cast("string"))), ",")


def secret_spans(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, n_assign, n_access, n_hex and base_sha256 of the plain findings, spans of all, n_added. See `find_secrets`."""
    base = F.filter("findings", lambda f: f["base"])
    count = lambda k: F.size(F.filter(base, lambda f: f["kind"] == k)).cast("bigint")
    return find_secrets(docs).select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS], F.sha2(shown(base), 256).alias("base_sha256"), shown(F.col("findings")).alias("spans"),
        (F.size("findings") - F.size(base)).cast("bigint").alias("n_added"),
    )


def redact_secrets(docs: DataFrame) -> DataFrame:
    """docs with all its rows and columns, every finding in text replaced by its kind in angle brackets. Null texts stay null."""

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            at = batch.schema.get_field_index("text")
            texts = pa.array([None if t is None else redacted(t) for t in batch["text"].to_pylist()], pa.string())
            columns = [texts if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema.set(at, pa.field("text", pa.string())))

    return docs.mapInArrow(batches, docs.schema)


def redacted(text: str) -> str:
    out, at = [], 0
    for f in all_findings(text):
        if f.start >= at:
            out += [text[at : f.start], f"<{f.kind}>"]
        at = max(at, f.stop)
    return "".join([*out, text[at:]]) if out else text
