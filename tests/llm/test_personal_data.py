"""Personal data against the plain patterns, and disguises by example."""

import hashlib
import random
import re

import pytest

from tables import awkward, documents, empty

from lintel.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    return sum(sum(divmod(int(x) * (1 + i % 2), 10)) for i, x in enumerate(reversed(d))) % 10 == 0


def brute(text):
    out = [(m.start(), m.end(), "email") for m in EMAIL.finditer(text)]
    out += [(m.start(), m.end(), "ip") for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        d = re.sub("[ -]", "", m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), m.end(), "card"))
    out += [(m.start(), m.end(), "phone") for m in PHONE.finditer(text) if 10 <= sum(c in "0123456789" for c in m[0]) <= 15]
    return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[2])))


def test_base_spans_of_noise():
    rng = random.Random(2)
    for _ in range(20000):
        text = "".join(rng.choice("ab1234567890..@@- +()é０一\n") for _ in range(rng.randint(0, 60)))
        assert pii.all_spans(text)[0] == brute(text), repr(text)


def test_long_runs_take_linear_time():
    for text in ("a" * 300000 + "@", "1" * 200000, "1.1" * 60000, "+1" + " " * 200000, "a.b" * 50000 + "[at]", "one " * 50000):
        pii.all_spans(text)


DISGUISED = {
    "mail john [at] example [dot] com now": "john [at] example [dot] com:email",
    "john.doe at example dot com": "john.doe at example dot com:email",
    "john(at)mail.example.com": "john(at)mail.example.com:email",
    "ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ": "ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ:email",
    "jоhn@exаmple.com": "jоhn@exаmple.com:email",
    "call +1 five five five one two three four five six seven ok": "+1 five five five one two three four five six seven:phone",
    "plus one five five five one two three four five six": "plus one five five five one two three four five six:phone",
    "ip 192 dot 168 dot 0 dot 1": "192 dot 168 dot 0 dot 1:ip",
    "one nine two dot one six eight dot zero dot one": "one nine two dot one six eight dot zero dot one:ip",
    "at 10[.]0[.]0[.]1": "10[.]0[.]0[.]1:ip",
    "jane dot roe at mail dot example dot org!": "jane dot roe at mail dot example dot org:email",
    "jo​hn@ex​ample.com": "jo​hn@ex​ample.com:email",
    "card ４５３２ ０１５１ １２８３ ０３６６": "４５３２ ０１５１ １２８３ ０３６６:card",
    "four five three two zero one five one one two eight three zero three six six": "four five three two zero one five one one two eight three zero three six six:card",
}
CLEAN = ["we met at noon. dot the i", "the at and dot of it", "un deux trois quatre cinq six", "one two three four", "look at this (dot) then", "a plus 3 is five", "Ärger im Café"]


def test_disguises():
    for text, want in DISGUISED.items():
        base, every = pii.all_spans(text)
        assert base == brute(text)
        assert want in [f"{text[a:b]}:{kind}" for a, b, kind in every], text
        assert want.rpartition(":")[0] not in pii.masked(text)
    for text in CLEAN:
        assert pii.all_spans(text) == ([], []), text


def test_table(spark):
    for docs in (documents(spark), awkward(spark, "spans", "n_email")):
        got = sorted((tuple(r) for r in pii.find_personal_data(docs).collect()), key=str)
        want = []
        for r in docs.select("doc_id", "text").collect():
            base = brute(r.text or "")
            digest = hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in base).encode()).hexdigest()
            want.append((r.doc_id, *(sum(s[2] == k for s in base) for k in pii.KINDS), digest))
        assert [g[:6] for g in got] == sorted(want, key=str)
    assert pii.find_personal_data(empty(spark)).count() == 0


def test_masking_keeps_rows_and_columns(spark):
    docs = awkward(spark, "spans")
    assert pii.mask_personal_data(docs).columns == docs.columns and pii.mask_personal_data(docs).count() == docs.count()
    done = pii.mask_personal_data(documents(spark))
    assert done.dtypes == documents(spark).dtypes
    rows = done.collect()
    assert not any(brute(r.text or "") for r in rows) and all(r.n_chars == len(r.text) for r in rows)


@pytest.mark.parametrize("text", [
    "jan at firma dot xyz", "marie (arobase) exemple.fr", "marie arobase exemple point fr", "jean.dupont arobase exemple point co point fr", "(jan at firma dot shop)",
])
def test_disguises_with_any_last_label_and_in_french(text):
    from lintel.llm.pii import all_spans

    spans = all_spans(f"Contact: {text}, thanks")[1]
    assert [f"{k}" for _, _, k in spans] == ["email"]
    a, b, _ = spans[0]
    assert f"Contact: {text}, thanks"[a:b] == text.strip("()")


@pytest.mark.parametrize("text", [
    "we arrived at this point in time", "look at polka dot dresses in the shop", "she looked at the dot xyz.", "un point de vue, une arobase", "at a point near the dot", "le signe arobase est un point",
])
def test_prose_is_no_disguise(text):
    from lintel.llm.pii import all_spans

    assert all_spans(text)[1] == []
