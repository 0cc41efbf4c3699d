import re

from placemat.llm import pii


def test_kinds():
    text = (
        "Mr. John Smith-Jones met Frau Müller; Dr Иван Петров. anna.b+x@mail-2.example.co.uk, 192.168.0.1. "
        "+49 (030) 123-4567 or 017-555-7713; 4111 1111 1111 1111! 123-45-6789, DE89 3704 0044 0532 0130 00 "
        "version 1.2.3 and 2020-01-02, 1.2.3.4.5, 999.1.1.1"
    )
    found = [(k, text[a:b]) for a, b, k, _ in pii.entities(text)]
    assert found == [
        ("person", "John Smith-Jones"), ("person", "Müller"), ("person", "Иван Петров"),
        ("email", "anna.b+x@mail-2.example.co.uk"), ("ip", "192.168.0.1"), ("phone", "+49 (030) 123-4567"),
        ("phone", "017-555-7713"), ("card", "4111 1111 1111 1111"), ("ssn", "123-45-6789"),
        ("iban", "DE89 3704 0044 0532 0130 00"),
    ]


def drawn(text, key="key"):
    return {(k, c): pii.surrogate(key, k, c, 0, g) for k, c, g in pii.keyed_parts(text)}


def test_names():
    """Every planted name, whatever follows it, and nothing more."""
    cases = {
        "Mr Namea met Mr Abel.": ["Namea", "Abel"], "Mr. O'Neil and Herr von Braun": ["O'Neil", "von Braun"],
        "Herr Prof. Dr. Müller": ["Müller"], "Mr. J. R. Smith-led Dr A.B. Jones Dr Abel": ["J. R. Smith", "A.B. Jones", "Abel"],
        "Mme Anne-Marie de la Tour, Sr José Luis García": ["Anne-Marie de la Tour", "José Luis García"],
        "Mr Abel Mrs Berg Miss Costa": ["Abel", "Berg", "Costa"], "Mr and Mrs Holm": ["Holm"], "Mr": [], "Dr. no": [], "MrAbel": [],
    }
    for text, names in cases.items():
        assert [text[a:b] for a, b, _, _ in pii.entities(text)] == names


def test_numbers_of_more_forms():
    text = "+1 5551234567; +33 6 12 34 56 78, 2001:db8::1 and fe80:0:0:0:1:2:3:4, not 12:30:45, a::b, 1:2:3:4 or 1712345678"
    found = [(k, text[a:b]) for a, b, k, _ in pii.entities(text)]
    assert found == [
        ("phone", "+1 5551234567"), ("phone", "+33 6 12 34 56 78"), ("ipv6", "2001:db8::1"), ("ipv6", "fe80:0:0:0:1:2:3:4"),
    ]
    new = pii.replace(text, drawn(text))[0]
    assert [k for _, _, k, _ in pii.entities(new)] == [k for k, _ in found]
    assert not any(mention in new for _, mention in found)


def test_people_and_domains_stay_themselves(spark):
    """One surrogate per person under any form of address; no two people alike, no original used."""
    families = [f"Fam{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(120)]
    texts = [f"{t} {f} wrote to x{i}@firm{i % 7}.com." for i, f in enumerate([*families, *pii.FAMILY["latin"]]) for t in ("Mr", "Mrs", "Dr")]
    texts += ["Dr Anna Bell, then Ms Anna Bell, later Ms Bell", "Mr John Smith and Mr Smith", "a@one.org b@one.org a@two.org"]
    got = pii.replace_entities(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    new = {r.doc_id: r.text for r in got}
    forward, back = {}, {}
    for i, text in enumerate(texts[:-3]):
        was, now = text.split()[1], new[i].split()[1]
        assert forward.setdefault(was, now) == now and back.setdefault(now, was) == was and now not in families + pii.FAMILY["latin"]
        was, now = text.split("@")[1], new[i].split("@")[1]
        assert forward.setdefault(was, now) == now and back.setdefault(now, was) == was
    first, second, third = re.findall(r"(?:Dr|Ms) ([\w -]+?)(?:,|$)", new[len(texts) - 3].replace(" then", "").replace(" later", ""))
    assert first == second and first.split()[0] in pii.GIVEN["latin", "f"] and first.endswith(f" {third}")
    one, two = re.fullmatch(r"Mr (.+) and Mr (.+)", new[len(texts) - 2]).groups()
    assert one.split()[0] in pii.GIVEN["latin", "m"] and one.split()[1] == two
    a, b, c = (x.split("@") for x in new[len(texts) - 1].split())
    assert a[1] == b[1] != c[1] and a[0] == c[0] != b[0]


def test_initials_differ():
    for letters in pii.ALPHABETS.values():
        moved = {pii.moved_initial("key", c.upper()) for c in letters}
        assert len(moved) == len(letters) and all(pii.moved_initial("key", c).lower() != c for c in letters)


def test_surrogates_keep_type_and_format():
    text = "Mrs Anna Bell, Herr Иван Петров, 4111-1111-1111-1111, DE89 3704 0044 0532 0130 00, JO.88@MAIL.example.com"
    table = drawn(text)
    new, n = pii.replace(text, table)
    assert n == 5 and [k for _, _, k, _ in pii.entities(new)] == [k for _, _, k, _ in pii.entities(text)]
    card = re.search(r"\d{4}-\d{4}-\d{4}-\d{4}", new)[0]
    assert pii.luhn(card.replace("-", "")) == 0
    iban = re.search(r"DE[\d ]+", new)[0].replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1
    woman, man = re.search(r"Mrs (\S+)", new)[1], re.search(r"Herr (\S+)", new)[1]
    assert woman in pii.GIVEN["latin", "f"] and man in pii.GIVEN["cyrillic", "m"]
    assert re.search(r"[A-Z]{2}\.\d\d@", new)
    assert pii.replace(text, table) == (new, n) and pii.surrogate("other", "ip", "1.2.3.4", 0) != pii.surrogate("key", "ip", "1.2.3.4", 0)


def test_distinct_and_same_everywhere(spark):
    """More women than names of two parts, so that rounds of drawing are needed; one address is in a third of all texts."""
    rows = []
    for i in range(900):
        shared = "mail same@one.example.com " if i % 3 == 0 else ""
        rows.append((i, f"{shared}Mrs Name{chr(97 + i % 26)}{chr(97 + i // 26)} wrote from 10.0.{i % 250}.{i // 250}."))
    got = {r.doc_id: r for r in pii.replace_entities(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    forward, back = {}, {}
    for i, text in rows:
        old, new = pii.entities(text), pii.entities(got[i].text)
        assert got[i].n_replaced == len(old) == len(new)
        for (a, b, kind, was), (_, _, _, now) in zip(old, new):
            assert text[a:b] not in got[i].text
            assert forward.setdefault((kind, was), now) == now and back.setdefault((kind, now), was) == was
    assert not {(k, v) for (k, _), v in forward.items()} & set(forward)


def test_short_addresses_of_many_domains(spark):
    """More two-letter addresses than one reserved domain has, and more one-letter ones than any form of their length."""
    two = [f"{p}@firm{i}.com" for i in range(1500) for p in ("hr", "it")]
    one = [f"{chr(97 + i % 26)}@{chr(97 + i // 26 % 26)}.{'abcdefg'[i // 676]}x" for i in range(7 * 676)]
    whole = [*two, *one]
    frame = spark.createDataFrame(list(enumerate(whole)), "doc_id long, text string")
    got = {whole[r.doc_id]: r.text for r in pii.replace_entities(frame, "key").collect()}
    assert set(got) == set(whole) and len({*got.values()}) == len(got) and not set(got) & {*got.values()}
    for value in got.values():
        assert [k for _, _, k, _ in pii.entities(value)] == ["email"] and value.endswith(".example")


def test_later_attempts_have_more_room():
    mentions = {
        "local": "A", "domain": "x.org", "iban": "DE89 3704 0044", "card": "4111 1111 1111 1111", "ssn": "123-45-6789",
        "phone": "017-555-7713", "family": "Bell", "given": "Anna",
    }
    for kind, mention in mentions.items():
        canonical = re.sub(r"\D", "", mention) if kind in pii.DIGITS else mention.lower().replace(" ", "")
        first, later = (pii.surrogate("key", kind, canonical, n) for n in (0, 16))
        assert len(later) > len(first)
        assert len(pii.rendered(kind, mention, later)) > len(pii.rendered(kind, mention, first))
    assert pii.luhn(pii.surrogate("key", "card", "4111111111111111", 16)) == 0
    assert {pii.surrogate("key", "ip", "10.0.0.1", n).split(".")[0] for n in (0, 7)} == {"10"} != {
        pii.surrogate("key", "ip", "10.0.0.1", n).split(".")[0] for n in range(8, 20)
    }


def test_query_finds_nothing_left(spark, small, texts):
    from placemat.llm.queries import QUERIES

    for r in QUERIES["op6_pii_surrogates"].build(spark, small).collect():
        old = pii.entities(texts[r.doc_id])
        assert r.n_replaced == len(old) and not any(texts[r.doc_id][a:b] in r.text for a, b, _, _ in old)
        if not old:
            assert r.text == texts[r.doc_id]


def test_odd_documents(odd, none):
    out = pii.replace_entities(odd, count=None)
    assert out.columns == odd.columns and out.count() == odd.count()
    assert out.where("text is null").count() == odd.where("text is null").count()
    assert "Anna.Bell" not in " ".join(r.text or "" for r in out.collect())
    assert pii.replace_entities(none).count() == 0


def test_scan_lets_every_form_through(spark):
    """Texts with one entity each, which the pattern of the scan must not hold back."""
    texts = ["at 2001:db8::1 now", "fe80:0:0:0:1:2:3:4", "+33 6 12 34 56 78", "Herr von Braun", "Mr. J. Smith", "a@b.org", "1.2.3.4", "12:30:45"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_replaced for r in pii.replace_entities(frame).collect()}
    assert [got[i] for i in range(len(texts))] == [1] * 7 + [0]
