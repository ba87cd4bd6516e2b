import hashlib
import re
from datetime import date, timedelta

from pyspark.sql import functions as F

from periodix.llm.pii import working_key, feistel, pseudonymise
from tests.llm.conftest import TEXTS

KEY = "a secret of these tests"
SECRET = working_key(KEY)


def shift(kind, r, size, half):
    return int(hashlib.sha256(f"{SECRET}|{kind}|{r}|{size}|{half}".encode()).hexdigest()[:15], 16) % size


def network(a, b, high, low, kind):
    for r in range(8):
        if r % 2 == 0:
            a = (a + shift(kind, r, high, b)) % high
        else:
            b = (b + shift(kind, r, low, a)) % low
    return a, b


def digits(s, kind):
    h = len(s) // 2
    a, b = network(int(s[:h]), int(s[h:]), 10**h, 10 ** (len(s) - h), kind)
    return f"{a:0{h}d}{b:0{len(s) - h}d}"


def ssn(area, group, serial):
    a, b = network(area - (2 if area > 666 else 1), (group - 1) * 9999 + serial - 1, 898, 99 * 9999, "ssn")
    return f"{a + (2 if a >= 665 else 1):03d}-{b // 9999 + 1:02d}-{b % 9999 + 1:04d}"


def check_digit(s):
    total = sum(sum(divmod(2 * int(c), 10)) if i % 2 == 0 else int(c) for i, c in enumerate(reversed(s)))
    return str(-total % 10)


def card(s):
    fresh = digits(s[:-1], "card")
    return fresh + check_digit(fresh)


def by_class(s, kind, letters):
    h = len(s) // 2
    halves = [s[:h], s[h:]]
    for r in range(8):
        mine, other = halves[r % 2], halves[1 - r % 2]
        bits = hashlib.sha512(f"{SECRET}|{kind}|{r}|{other.lower()}".encode()).hexdigest()
        out = []
        for i, c in enumerate(mine):
            by = int(bits[(i * 3) % 126:(i * 3) % 126 + 3], 16)
            for first, size, pattern in (("0", 10, "[0-9]"), ("a", letters, "[a-z]"), ("A", letters, "[A-Z]")):
                if re.match(pattern, c):
                    c = chr(ord(first) + (ord(c) - ord(first) + by) % size)
                    break
            out.append(c)
        halves[r % 2] = "".join(out)
    return "".join(halves)


def run(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r for r in pseudonymise(docs, KEY).collect()}


def test_values_by_brute_force(spark):
    number = "4111111111111111"
    day = date(1800, 1, 1) + timedelta(days=(lambda a, b: a * 773 + b)(*network(*divmod((date(2024, 2, 29) - date(1800, 1, 1)).days, 773), 189, 773, "date")))
    christmas = date(1800, 1, 1) + timedelta(days=(lambda a, b: a * 773 + b)(*network(*divmod((date(1980, 12, 25) - date(1800, 1, 1)).days, 773), 189, 773, "date")))
    a, b = network(10 * 256 + 20, 30 * 256 + 40, 65536, 65536, "ip")
    token = "0123456789abcdef" * 2
    phone = digits("0175557713", "phone")
    cases = [
        (f"pay {number}.", f"pay {card(number)}."), ("4111 1111-1111 1111!!", re.sub(r"(....)(....)(....)(....)", r"\1 \2-\3 \4", card(number)) + "!!"),
        ("4111111111111112", None), ("x4111111111111111", None), ("2024-02-29", day.isoformat()), ("29.02.2024", day.strftime("%d.%m.%Y")), ("29/02/2024", day.strftime("%d/%m/%Y")),
        ("2023-02-29 and 31.04.2020 and 1700-01-01", None), ("10.20.30.40", f"{a // 256}.{a % 256}.{b // 256}.{b % 256}"), ("10.20.30.256 and 1.2.3.4.5", None),
        ("call +1 (017) 555-7713 now", f"call +1 ({phone[:3]}) {phone[3:6]}-{phone[6:]} now"), ("+1 23", None),
        ("hein.19@mail5.example.com", by_class("hein.19", "email", 26) + "@mail5.example.com"), (f'token = "{token}"', f'token = "{by_class(token, "token", 6)}"'),
        ("+1 (017) 555-7713 10.20.30.40", f"+1 ({phone[:3]}) {phone[3:6]}-{phone[6:]} {a // 256}.{a % 256}.{b // 256}.{b % 256}"), ("+1 (017) 555-7713 12 eggs", f"+1 ({phone[:3]}) {phone[3:6]}-{phone[6:]} 12 eggs"),
        ("1" * 32, None), ("123-45-6789", ssn(123, 45, 6789)), ("", None), ("plain words", None),
        (f"{number} {number}\n{number}", f"{card(number)} {card(number)}\n{card(number)}"), ("4111111111111111 10.20.30.40", f"{card(number)} {a // 256}.{a % 256}.{b // 256}.{b % 256}"),
        ("000-00-0000 666-12-1234 901-12-1234 123-00-1234 123-45-0000", None), ("899-99-9999 and 001-01-0001", f"{ssn(899, 99, 9999)} and {ssn(1, 1, 1)}"),
        ("12/25/1980 25/12/1980 13/13/1980", f"{christmas.strftime('%m/%d/%Y')} {christmas.strftime('%d/%m/%Y')} 13/13/1980"), (f"{'0123456789abcdef' * 4}", by_class("0123456789abcdef" * 4, "token", 6)),
    ]
    got = run(spark, [t for t, _ in cases])
    for i, (text, want) in enumerate(cases):
        assert got[i].text == (text if want is None else want)
        assert got[i].n_replaced == (0 if want is None else got[i].n_replaced) and got[i].n_replaced == sum(got[i].kinds.values())
    assert got[20].kinds == {"card": 3} and got[21].kinds == {"card": 1, "ip": 1}


def test_network_is_a_permutation(spark):
    pairs = spark.range(21 * 13).select(F.floor(F.col("id") / 13).alias("a"), (F.col("id") % 13).alias("b"))
    out = pairs.select(feistel(F.col("a"), F.col("b"), F.lit(21), F.lit(13), KEY, "t").alias("p")).select("p.a", "p.b").collect()
    assert sorted(map(tuple, out)) == [(a, b) for a in range(21) for b in range(13)]


def test_links_and_odd_rows(spark, odd_docs, no_docs):
    got = run(spark, ["Ab.1@x.org", "ab.1@x.org", "5500005555555559 a" * 3000])
    assert got[0].text.lower() == got[1].text and got[0].text[0].isupper()
    assert got[2].n_replaced == 1 or set(got[2].kinds) == {"card"}
    rows = pseudonymise(odd_docs, KEY).collect()
    assert sorted(((r.doc_id, r.text) for r in rows), key=str) == sorted(TEXTS, key=str)
    assert all(r.n_replaced == 0 and r.kinds == {} for r in rows)
    assert pseudonymise(no_docs, KEY).count() == 0
    plan = pseudonymise(odd_docs, KEY)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "Exchange" not in plan and KEY not in plan
