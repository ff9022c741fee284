import hashlib
import math
import random
import re
from collections import Counter

from llm_helpers import documents, edge_rows

from weekwise.llm import pii
from weekwise.llm.common import Scratch

PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
            ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]
PIECES = ["a", "Z", "9", "1", "255", "256", "0", ".", "@", "+", "-", " ", "(", ")", "%", "_", "\n", "é", "😀",
          "4111111111111111", "x.y", "1.2.3.4", "a@b.c", " 4111 1111-1111 1111", "+1 (988) 555-2485", "00"]


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        x = int(c) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def brute(text):
    out = []
    for kind, pattern in PATTERNS:
        for m in re.finditer(pattern, text or "", re.A):
            digits = re.sub("[^0-9]", "", m.group())
            if (kind == "ip" and max(map(int, m.group().split("."))) > 255
                    or kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits))
                    or kind == "phone" and not 8 <= len(digits) <= 15):
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_base_spans_and_discovery(spark):
    r = random.Random(5)
    rows = [(i, "".join(r.choice(PIECES) for _ in range(r.randint(0, 40)))) for i in range(1500)]
    rows += [(2000, None), (2001, ""), (2002, "9" * 40_000), (2003, "a" * 3000), (2004, "a@b.c " * 700),
             (2005, "1." * 10_000), (2006, "+1" + " 2" * 2000), (None, "x 1.2.3.4"), (5, "+1 (988) 555-2485 twice")]
    rows += [(3000 + k, f"please call me at +1 988 555 {2000 + k} thanks") for k in range(40)]
    rows += [(4000 + k, f"please call me at 988-555-{2000 + k}, thanks") for k in range(5)]
    rows += [(5000, "please call me at noon, thanks"), (5001, "not a known context 988-555-2000")]
    docs = documents(spark, rows)
    found = pii.personal_data(docs).collect()
    texts = {}
    for i, t in rows:
        texts.setdefault(i, []).append(brute(t))
    for row in found:
        base = next(b for b in texts[row.doc_id]
                    if hashlib.sha256(",".join(b).encode()).hexdigest() == row.base_sha256)
        texts[row.doc_id].remove(base)
        counts = [sum(x.startswith(k + ":") for x in base) for k, _ in PATTERNS]
        assert counts == [row.n_email, row.n_ip, row.n_card, row.n_phone]
        spans = row.spans.split(",") if row.spans else []
        assert set(base) <= set(spans)
        if row.doc_id in range(4000, 4005):
            assert spans == ["phone:18:30"]
        if row.doc_id in (5000, 5001):
            assert spans == []
    assert not any(texts.values())


def test_unrelated_documents_remove_no_marks(spark):
    rows = [(k, f"please call me at +1 988 555 {2000 + k} thanks") for k in range(8)]
    rows += [(100, "please call me at 988-555-3000, thanks")]
    rows += [(1000 + k, " ".join(f"u{k}x{j}@b.c" for j in range(400))) for k in range(21)]
    spans = {r.doc_id: r.spans for r in pii.personal_data(documents(spark, rows)).collect()}
    assert spans[100] == "phone:18:30"


def test_discovery_over_separators_and_from_the_whole_text(spark):
    long = "x" * 300
    rows = [(k, f"please call me at +1 988 555 {2000 + k} thanks") for k in range(40)]
    rows += [(100 + k, f"Phone: +1 988 555 {2000 + k}") for k in range(20)]
    rows += [(200 + k, f"he says {long} at +1 988 555 {2000 + k}") for k in range(20)]
    rows += [(300 + k, f"now write to joe{k}@example.com soon") for k in range(40)]
    rows += [(400 + k, f"now pay with 4111 1111 1111 1111 or {k}") for k in range(3)]
    rows += [(500 + k, f"+1 988 555 {2000 + k} is it") for k in range(20)]
    cases = [("please call me at ", "(988) 555-2485", "phone"), ("please call me at ", "988 555 2485", "phone"),
             ("please call me at ((", "(988) 555 2485", "phone"), ("please call me at\n", "988-555-2485", "phone"),
             ("please call me at ", "988.555.2485", "phone"), ("please call me at ", "988 - 555 - 2485", "phone"),
             ("please call me at ", "988-555-2485", "phone", " 24 hours"), ("Phone: ", "988 555 2485", "phone"),
             ("", "988 555 2485", "phone"), (f"he says {long} at ", "988 555 2485", "phone"),
             ("now write to ", "jane[at]example.com", "email"), ("now write to ", "jane(at)example.com", "email"),
             ("now write to ", "jane [AT] example.com", "email")]
    want = {}
    for i, (head, found, kind, *rest) in enumerate(cases):
        rows.append((1000 + i, head + found + (rest[0] if rest else ", thanks")))
        want[1000 + i] = f"{kind}:{len(head)}:{len(head) + len(found)}"
    rows += [(2000, "please call me at 12 30 or so"), (2001, "an unknown context 988 555 2485"),
             (2002, "please call me at " + "1 " * 3000), (2003, "988 555 2485 " * 50), (2004, "(at) [at]" * 500)]
    spans = {r.doc_id: r.spans for r in pii.personal_data(documents(spark, rows)).collect()}
    assert {i: spans[i] for i in want} == want
    assert spans[2000] == spans[2001] == ""


def test_empty_and_edges(spark):
    assert pii.personal_data(documents(spark, [])).collect() == []
    assert pii.personal_data(documents(spark, edge_rows())).count() == len(edge_rows())


def test_a_pattern_is_no_evidence_for_itself(spark):
    """Plain numbers that outnumber the phones after the same words are not marked."""
    rows = [(k, f"so the ref number is +1 988 555 {2000 + k} then") for k in range(50)]
    rows += [(100 + k, f"so the ref number is 77{k:02}345{k:02} then") for k in range(60)]
    spans = {r.doc_id: r.spans for r in pii.personal_data(documents(spark, rows)).collect()}
    assert [spans[100 + k] for k in range(60)] == [""] * 60


def test_a_pattern_may_mark_several_kinds(spark):
    rows = [(k, f"you can reach me at +1 988 555 {2000 + k} now") for k in range(50)]
    rows += [(100 + k, f"you can reach me at joe{k}@example.com now") for k in range(50)]
    rows += [(200, "you can reach me at 988-555-7777 now"), (201, "you can reach me at jane[at]example.com now")]
    spans = {r.doc_id: r.spans for r in pii.personal_data(documents(spark, rows)).collect()}
    assert spans[200] == "phone:20:32" and spans[201] == "email:20:39"


def test_confidence_equals_a_plain_bootstrap(spark):
    """A random graph of patterns and instances against loops over it."""
    r = random.Random(12)
    seeds = {f"+1988555{k:04}": "phone" for k in range(12)} | {f"1.2.3.{k}": "ip" for k in range(6)}
    plain = [f"9885551{k:03}" for k in range(25)] + ["noon", "x7"]
    edges = [(f"p{r.randrange(9)}", i) for i in r.choices([*seeds, *seeds, *plain], k=260)]
    tokens = [(0, [(p, i, seeds.get(i)) for p, i in edges])]
    df = documents(spark, [(1, "x")]).sparkSession.createDataFrame(
        tokens, "row long, tokens array<struct<pattern: string, found: string, seed: string>>")
    got = {(x.kind, x.pattern): x.confidence for x in pii.confident_patterns(
        df, Scratch(spark, "test"), rounds=3, confidence=0.0, least_seeds=3).collect()}
    n = Counter(edges)
    kinds = [(k, p) for p in {p for p, _ in n} for k in pii.KINDS
             if len({i for q, i in n if q == p and seeds.get(i) == k}) >= 3]
    near = {(k, p, i): c for k, p in kinds for (q, i), c in n.items()
            if q == p and (seeds.get(i) == k or re.search(pii.LOOKS[k], i))}
    conf = dict.fromkeys(kinds, 0.0)
    for _ in range(3):
        new = {}
        for k, p in kinds:
            total = 0.0
            for (k2, p2, i), c in near.items():
                if (k2, p2) == (k, p):
                    fail = math.prod(1 - min(0.999, conf[k, q]) for k3, q, j in near if k3 == k and j == i and q != p)
                    total += c * (1.0 if seeds.get(i) == k else 0.0 if i in seeds else 1 - fail)
            new[k, p] = total / (sum(c for (k2, p2, _), c in near.items() if (k2, p2) == (k, p)) + 1)
        conf = new
    assert got.keys() == conf.keys() and len(got) > 5
    assert all(abs(got[x] - conf[x]) < 1e-6 for x in conf)
