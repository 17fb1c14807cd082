import random
import re
from datetime import date

from supplylake.llm.pseudonyms import Feistel, Pseudonyms, iban_check, luhn, pseudonymize

from .cases import LONG, awkward, empty
from .test_ngram_join import frame

KEY = b"test key"


def test_feistel_is_a_permutation_of_any_size():
    f = Feistel(KEY)
    for size in (1, 2, 3, 7, 10, 97, 1000, 1023):
        out = [f.permuted(v, size, "t") for v in range(size)]
        assert sorted(out) == list(range(size))
        assert [f.permuted(v, size, "t", back=True) for v in out] == list(range(size))
    assert [f.permuted(v, 1000, "u") for v in range(9)] != [f.permuted(v, 1000, "t") for v in range(9)]


def values(rng):
    body = "".join(rng.choice("0123456789") for _ in range(15))
    bban = "".join(rng.choice("0123456789") for _ in range(18))
    return {
        "card": f"{body}{luhn(body)}", "phone": f"+1 ({rng.randint(100, 999)}) 555-{rng.randint(0, 9999):04d}",
        "ip": ".".join(str(rng.randint(0, 255)) for _ in range(4)), "ssn": f"{rng.randint(1, 665):03d}-{rng.randint(1, 99):02d}-{rng.randint(1, 9999):04d}",
        "date": date(rng.randint(1900, 2099), rng.randint(1, 12), rng.randint(1, 28)).isoformat(),
        "iban": f"DE{iban_check('DE', bban)}{bban}", "email": f"{rng.choice(['ann', 'Bob.x', 'und'])}.{rng.randint(0, 99)}@mail7.example.com",
    }


def test_values_keep_their_format_and_validity_and_can_be_inverted():
    rng = random.Random(1)
    there, back = Pseudonyms(KEY), Pseudonyms(KEY, back=True)
    for _ in range(300):
        for kind, value in values(rng).items():
            text = f"Call {value}, or"
            new, spans = there.replaced(text)
            assert [s[2] for s in spans] == [kind] and text[spans[0][0]:spans[0][1]] == value
            made = new[5:-4]
            shape = lambda s: re.sub("[A-Z]", "A", re.sub("[a-z]", "a", re.sub("[0-9]", "9", s)))
            if kind == "ip":
                assert all(0 <= int(p) <= 255 for p in made.split("."))
            else:
                assert shape(made) == shape(value)
            if kind == "card":
                assert luhn(made[:-1]) == int(made[-1])
            if kind == "date":
                date.fromisoformat(made)
            if kind == "iban":
                assert iban_check("DE", made[4:]) == made[2:4]
            assert back.replaced(new)[0] == text, kind


def test_dates_in_every_order_invert():
    there, back = Pseudonyms(KEY), Pseudonyms(KEY, back=True)
    for text in ("31/12/1999", "1/2/2003", "12.11.2010", "12/31/1999", "9.9.2099", "28/2/2000", "10/3/1901", "02/13/1950"):
        new, spans = there.replaced(text)
        assert len(spans) == 1 and back.replaced(new)[0] == text, (text, new, back.replaced(new))


def test_equal_values_stay_linked_and_invalid_ones_stay():
    there = Pseudonyms(KEY)
    card = "411111111111111" + str(luhn("411111111111111"))
    spaced = " ".join(card[k:k + 4] for k in range(0, 16, 4))
    a, b = there.replaced(card)[0], there.replaced(spaced)[0]
    assert a == b.replace(" ", "") != card
    assert re.sub("[^0-9]", "", there.replaced("(974) 555-3436")[0]) == re.sub("[^0-9]", "", there.replaced("+1 (974) 555-3436")[0][2:])
    for text in ("9807915762804491", "0000000000000000", "2001-02-30", "256.1.1.1", "000-12-3456", "666-12-3456", "1.2.3.4.5",
                 "version 3.14", "DE00123456780000000000", "a@b", "12/2020", "", "no digits here"):
        assert there.replaced(text) == (text, []), text
    two = f"{card} {card}"
    assert len(there.replaced(two)[1]) == 2


def test_table(spark):
    docs = awkward(spark)
    got = pseudonymize(docs, KEY).collect()
    assert len(got) == docs.count() and all(r.found == 0 for r in got)
    text = LONG + " und.34@mail7.example.com " + "9" * 4000 + "a" * 100_000 + "@"
    rows = [(1, text), (2, "x 74.55.1.2"), (3, "y 74.55.1.2")]
    table = pseudonymize(frame(spark, rows), KEY)
    by = {r.doc_id: r for r in table.collect()}
    assert by[1].found == 1 and by[1].text.startswith(LONG) and by[2].text[2:] == by[3].text[2:] != "74.55.1.2"
    back = pseudonymize(table, KEY, back=True)
    assert {r.doc_id: r.text for r in back.collect()} == dict(rows)
    assert pseudonymize(empty(spark), KEY).count() == 0


def test_values_before_capitals_digits_and_punctuation():
    there, back = Pseudonyms(KEY), Pseudonyms(KEY, back=True)
    for country, size in {"ES": 24, "AT": 20, "BE": 16, "SE": 24, "CZ": 24, "PL": 28, "RO": 24, "DE": 22, "FR": 27}.items():
        for seed in range(30):
            bban = "".join(random.Random(f"{country}{seed}").choice("0123456789") for _ in range(size - 4))
            plain = country + iban_check(country, bban) + bban
            for value in (plain, " ".join(plain[k:k + 4] for k in range(0, size, 4))):
                for after in ("", " BIC", " EUR", " 25", " 2512 AB", " ABCDEF", ", or", ".", " and"):
                    text = f"to {value}{after}"
                    new, spans = there.replaced(text)
                    assert [(text[a:b], k) for a, b, k in spans] == [(value, "iban")], text
                    assert back.replaced(new)[0] == text
    values = {"3782 822463 10005": "card", "3782-822463-10005": "card", "378282246310005": "card", "+491701234567": "phone",
              "+12025550123": "phone", "555.123.4567": "phone", "555-123-4567": "phone"}
    for value, kind in values.items():
        for after in ("", " BIC", " 25", ", or", ".", ")", " and", ";"):
            text = f"Call {value}{after}"
            new, spans = there.replaced(text)
            assert [(text[a:b], k) for a, b, k in spans] == [(value, kind)], text
            assert new != text and back.replaced(new)[0] == text
    digits = lambda s: re.sub("[^0-9]", "", there.replaced(s)[0])
    assert digits("+1 202 555 0123") == digits("+12025550123")
    assert there.replaced("555.123.4567.8 1.555.123.4567")[1] == []


def test_a_day_has_one_pseudonym_in_all_notations():
    there, back = Pseudonyms(KEY), Pseudonyms(KEY, back=True)
    rng = random.Random(4)
    days = [date(rng.randint(1900, 2099), rng.randint(1, 12), rng.randint(1, 28)) for _ in range(300)]
    names = "January February March April May June July August September October November December".split()
    for d in [*days, date(2000, 2, 29), date(2024, 12, 31), date(1969, 1, 1), date(2068, 12, 31), date(2024, 5, 5)]:
        name = names[d.month - 1]
        forms = [f"{d:%Y-%m-%d}", f"{d:%Y/%m/%d}", f"{d:%d/%m/%Y}", f"{d:%d.%m.%Y}", f"{d.day}/{d.month}/{d.year}", f"{d.day} {name} {d.year}",
                 f"{name} {d.day}, {d.year}", f"{d.day:02d} {name[:3]} {d.year}", f"{name[:3]} {d.day}, {d.year}"]
        readings = [lambda t: date.fromisoformat(t), lambda t: date.fromisoformat(t.replace("/", "-")),
                    *[lambda t: date(*map(int, reversed(re.split("[/.]", t))))] * 3,
                    *[lambda t: date(int(t[-4:]), [m[:3] for m in names].index(re.search("[A-Za-z]{3}", t)[0]) + 1, int(re.search("[0-9]+", t)[0]))] * 4]
        if d.day > 12:
            forms.append(f"{d:%m/%d/%Y}")
            readings.append(lambda t: date(int(t[6:]), int(t[:2]), int(t[3:5])))
        if 1969 <= d.year <= 2068:
            forms.append(f"{d:%d/%m/%y}")
            readings.append(lambda t: date(1900 + int(t[6:]) + 100 * (int(t[6:]) < 69), int(t[3:5]), int(t[:2])))
        seen = set()
        for form, read in zip(forms, readings):
            text = f"on {form}, then"
            new, spans = there.replaced(text)
            assert [(text[a:b], k) for a, b, k in spans] == [(form, "date")], text
            assert back.replaced(new)[0] == text, (text, new, back.replaced(new)[0])
            seen.add(read(new[3:-6]))
        assert len(seen) == 1, (d, seen)


def test_more_notations_of_numbers():
    there, back = Pseudonyms(KEY), Pseudonyms(KEY, back=True)
    values = {"555 123 4567": "phone", "1-800-555-0199": "phone", "020 7946 0958": "phone", "+44 (0)20 7946 0958": "phone",
              "123 45 6789": "ssn", "2001:db8::ff00:42:8329": "ipv6", "fe80::1": "ipv6"}
    bban = "370400440532013000"
    values[f"de{iban_check('DE', bban)}{bban}"] = "iban"
    for value, kind in values.items():
        for after in ("", ", or", " and", ")"):
            text = f"Call {value}{after}"
            new, spans = there.replaced(text)
            assert [(text[a:b], k) for a, b, k in spans] == [(value, kind)], (text, spans)
            assert new != text and back.replaced(new)[0] == text, (text, new)
    digits = lambda s: re.sub("[^0-9]", "", there.replaced(s)[0])
    assert digits("555 123 4567") == digits("(555) 123-4567") == digits("1-555-123-4567")[1:]
    assert digits("123 45 6789") == digits("123-45-6789")
    plain = f"DE{iban_check('DE', bban)}{bban}"
    assert there.replaced(plain.lower())[0].upper() == there.replaced(plain)[0]
    for text in ("at 10:30:15 today", "std::vector<int>", "a::b", "1 555 123 4567 9", "12/31/24/7", "May 32, 2024", "31 June 2024", "30/02/24",
                 "5 Mai 2024", "ratio 3:4:5", "::", "year 1899-01-01"):
        assert there.replaced(text) == (text, []), (text, there.replaced(text))
