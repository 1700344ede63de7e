"""The hand-written signatures: what every match holds, and the scan against a plain one."""

import random
import re
import string

from linkloom.llm import licenses
from linkloom.llm.license_signatures import ROOTS

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def samples(regex: str, rng: random.Random, n: int = 12) -> set[str]:
    """Some texts that the regex matches, optional parts in or out and branches dealt."""
    parser = re._parser

    def spell(parts) -> str:
        out = ""
        for op, arg in parts:
            op = str(op)
            if op == "LITERAL":
                out += chr(arg)
            elif op == "SUBPATTERN":
                out += spell(arg[-1])
            elif op == "BRANCH":
                out += spell(rng.choice(arg[1]))
            elif op == "MAX_REPEAT":
                low, high, of = arg
                out += "".join(spell(of) for _ in range(rng.randint(low, min(int(high), low + 1))))
            elif op == "IN":
                kind, value = rng.choice(arg)
                out += chr(value) if str(kind) == "LITERAL" else chr(value[0]) if str(kind) == "RANGE" else "x"
            else:
                raise ValueError(op)
        return out

    return {spell(parser.parse(regex)) for _ in range(n)}


def plain_scan(text: str | None, rules: list) -> tuple[str, float]:
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    norm = "".join(f" {w}" for w in words) + " "
    spans = sorted({(m.start(), -m.end(), -r.priority, r.label, r.score) for r in rules for m in re.finditer(f" (?:{r.regex})(?= )", norm)})
    kept = [s for k, s in enumerate(spans) if not any(o[0] <= s[0] and o[1] <= s[1] and o[2] <= s[2] for o in spans[:k])]
    base = {label for phrase, label in licenses.BASE.items() if f" {phrase} " in norm}
    return ",".join(sorted(base | {s[3] for s in kept})), max((s[4] for s in kept), default=0.7 if base else 0.0)


def test_every_match_holds_its_keyword_and_a_root():
    rng = random.Random(4)
    rules = licenses.rules()
    assert len(rules) > 300
    for r in rules:
        for text in samples(r.regex, rng):
            assert re.fullmatch(r.regex, text), (r, text)
            assert r.keyword in text, (r, text)
            assert any(root in r.keyword for root in ROOTS), r


def test_scan_equals_plain_scan(spark):
    rng = random.Random(5)
    rules = licenses.rules()
    texts = [t.title() for r in rules for t in sorted(samples(r.regex, rng, 3))]
    mixed = [", ".join(rng.sample(texts, 5)) for _ in range(200)]
    odd = ["", None, "no rights reserved", "Some rights reserved.", "all rights reserved", "GPL " * 3000, "cc by cc by-nc 4.0 x mit licensed mit license"]
    rows = list(enumerate(texts + mixed + odd))
    got = {r.doc_id: (r.labels, r.score) for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, text in rows:
        assert got[k] == plain_scan(text, rules), text and text[:300]


def test_some_and_no_rights_are_not_reserved(spark):
    docs = spark.createDataFrame([(1, "No rights reserved"), (2, "Some rights reserved"), (3, "All rights reserved")], "doc_id long, text string")
    got = {r.doc_id: r.labels for r in licenses.license_scan(docs).collect()}
    assert got == {1: "no-rights-reserved", 2: "some-rights-reserved", 3: "reserved"}
