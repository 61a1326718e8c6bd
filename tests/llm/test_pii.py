import hashlib
import random
import re

from hearthlake.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def base(text):
    out = []
    for place, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 12 <= len(d) <= 19 and luhn(d),
                "phone": 9 <= len(d) <= 15,
            }[kind]
            if good:
                out.append((m.start(), place, m.end(), kind))
    return sorted(out)


def by_hand(doc_id, text):
    spans = base(text)
    names = ",".join(f"{k}:{s}:{e}" for s, _, e, k in spans)
    counts = [sum(k == kind for *_, k in spans) for kind in PATTERNS]
    return (doc_id, *counts, hashlib.sha256(names.encode()).hexdigest())


def texts():
    rng = random.Random(4)
    out = [
        "", None, "no data", "a@b.com_x@y.org", "a@b.com..foo@bar.co.uk.", "x@y x@y.z. @a.b q@@r.s.t", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.255 1.2.3",
        "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111", "+1 (555) 123-4567 and +49 30 1234 5678 9, +1 (2) 44.1.2.3 5",
        "é😀 mail ü@x.de a.b@x.de", "+1-2", "0 " * 30, "a." * 400 + "@", "a@" + "b." * 400 + "c", "1" * 3000, "+" * 50 + "1 2 3 4 5 6 7 8 9",
        "call 555-123-4567 now", "write bob (at) example (dot) com", "0000000000000000 00000000000000",
    ]
    out += ["".join(rng.choice("0123456789 .-+()@ab\né") for _ in range(rng.randint(0, 120))) for _ in range(250)]
    return out


def test_base_spans_against_brute_force(docs, staging):
    rows = [(i, t) for i, t in enumerate(texts())] + [(None, "x@y.z"), (0, "x@y.z"), (0, "x@y.z")]
    got = pii.personal_data(staging, docs(rows, spans="s", kind="k", row="r").repartition(3)).collect()
    assert sorted((tuple(r)[:6] for r in got), key=repr) == sorted((by_hand(*r) for r in rows), key=repr)
    for r in got:
        text = dict(rows[:-3]).get(r.doc_id) if r.doc_id else None
        if text is not None:
            assert set(f"{k}:{s}:{e}" for s, _, e, k in base(text)) <= set(filter(None, r.spans.split(",")))


def test_nothing_and_very_long(docs, staging):
    assert pii.personal_data(staging, docs([])).count() == 0
    long = "word " * 50_000 + "x@y.org " + "9" * 50_000 + " 10.0.0.1"
    (row,) = pii.personal_data(staging, docs([(1, long)])).collect()
    assert tuple(row)[:6] == by_hand(1, long)


def test_wider_candidates_are_added_when_they_look_like_known_ones(docs, staging):
    rng = random.Random(6)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    rows = [(i, f"please call +1 ({digits(3)}) {digits(3)}-{digits(4)} today") for i in range(150)]
    rows += [(1000 + i, f"total {digits(16)} units") for i in range(150)]
    rows += [(5000, "please call 1 (555) 867-5309 today"), (5001, "total 1234567890123456 units"), (5002, "nothing here")]
    got = {r.doc_id: r.spans for r in pii.personal_data(staging, docs(rows)).collect()}
    assert got[5000] == "phone:12:28" and got[5001] == "" and got[5002] == ""


def test_a_number_that_runs_into_an_address_is_added(docs, staging):
    """The base phone match takes both and fails; the grouped number alone has a known phone's format."""
    rng = random.Random(8)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    rows = [(i, f"a +1 ({digits(3)}) {digits(3)}-{digits(4)} word") for i in range(150)]
    rows += [(1000 + i, f"b 10.{rng.randrange(256)}.{rng.randrange(100, 256)}.{rng.randrange(100, 256)} word") for i in range(150)]
    rows += [(2000 + i, f"c {digits(16)} word") for i in range(150)]
    rows += [(5000, "a +1 (826) 555-4081 190.137.223.204 word"), (5001, "no. 2024-05-17 12 word"), (5002, "isbn 978-0-306-40615-7 x")]
    got = {r.doc_id: r for r in pii.personal_data(staging, docs(rows)).collect()}
    assert got[5000].spans == "phone:2:19,ip:20:35" and (got[5000].n_spans, got[5000].n_added) == (2, 1)
    assert got[5001].spans == got[5002].spans == ""
    assert not any(got[2000 + i].n_added for i in range(150))


def account(rng):
    """An account number with right check digits."""
    body = "".join(rng.choice("0123456789") for _ in range(18))
    check = 98 - int(body + "131400") % 97
    whole = f"DE{check:02d}{body}"
    return " ".join(whole[i : i + 4] for i in range(0, len(whole), 4))


def test_account_numbers_by_check_sum(docs, staging):
    rng = random.Random(9)
    right = [account(rng) for _ in range(60)]
    wrong = [a[:-1] + str((int(a[-1]) + 1) % 10) for a in right[:2]]
    rows = [(i, f"iban {a} please") for i, a in enumerate(right)] + [(100 + i, f"iban {a} please") for i, a in enumerate(wrong)]
    got = {r.doc_id: r.spans for r in pii.personal_data(staging, docs(rows)).collect()}
    assert all(f"iban:5:{5 + len(a)}" in got[i].split(",") for i, a in enumerate(right))
    assert not any("iban" in got[100 + i] for i in range(len(wrong)))


def test_written_out_addresses_are_added(docs, staging):
    rows = [(i, f"mail name{i}@host{i % 7}.org now") for i in range(60)]
    rows += [(100, "write bob (at) example (dot) com"), (101, "write ann at example dot org now"), (102, "meet at noon, dot it")]
    rows += [(200, "from 2001:db8:0:1:2:3:4:5 on")]
    got = {r.doc_id: r.spans for r in pii.personal_data(staging, docs(rows)).collect()}
    assert got[100] == "email:6:32" and got[101] == "email:6:28" and got[102] == ""


def test_main_path_has_no_python(docs, staging, plan_of):
    assert "Python" not in plan_of(pii.personal_data(staging, docs([(1, "a@b.c")])))


def test_redaction(docs, staging):
    got = {r.doc_id: r.text for r in pii.redacted(staging, docs([(1, "é x@y.org, 10.0.0.1!"), (2, "plain"), (3, None)])).collect()}
    assert got == {1: "é [EMAIL], [IP]!", 2: "plain", 3: None}
