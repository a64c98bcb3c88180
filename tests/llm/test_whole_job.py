"""Inputs that the given tables do not hold."""

from __future__ import annotations

import itertools
import random
import re

import pyarrow as pa
import pytest

from deskspark.llm import contamination, packing, pii, secret_scan

SECRET = "9233a8ec0f1b4d5e6a7b8c9d0e1f2a3b4c5d6e7f"


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "src") for i, t in texts], "doc_id long, text string, source string")


def test_assigned_values_are_candidates_in_their_context(spark):
    texts = {
        1: f"TOKEN={SECRET}", 2: f"export API_KEY={SECRET}\nnext", 3: f"see https://h.example/a?x=1&access_token={SECRET}&y=2",
        4: f"aws_secret_access_key={SECRET}", 5: f"my_service_account_password = '{SECRET}'", 6: f'"token":"{SECRET}"',
        7: f"token={SECRET}==", 8: f"\U0001f600 first_long_identifier/second_long_name token={SECRET}"}
    rows = secret_scan.candidates(docs_of(spark, texts.items())).collect()
    values = {r.doc_id: r for r in rows if r.value.rstrip("=") == SECRET}
    assert set(values) == set(texts) and all(r.credential and r.assigned == 1.0 for r in values.values())
    assert values[7].value == f"{SECRET}==" and values[4].before == "awssecretaccesskey"
    assert {r.value for r in rows if r.doc_id == 4} == {"aws_secret_access_key", SECRET}


def test_assigned_values_are_redacted(spark):
    turned = lambda i: SECRET[i:] + SECRET[:i]
    forms = ("TOKEN={}", "https://h.example/?access_token={}&y", "aws_secret_access_key={}")
    texts = [(i, f"{forms[i % 3].format(turned(i))} internationalizationword{'abcdefgh'[i % 8]}") for i in range(30)]
    docs = docs_of(spark, texts)
    out = {r.doc_id: r.text for r in secret_scan.redact(docs, secret_scan.scan(docs)).collect()}
    assert out == {i: t.replace(turned(i), "<secret>") for i, t in texts}


def test_rare_secrets_are_found_and_one_label_is_no_constant(spark, monkeypatch):
    monkeypatch.setattr(secret_scan, "LABELLED_ROWS", 20)  # the few secrets are a small part of the findings
    turned = lambda i: SECRET[i:] + SECRET[:i]
    plain = [(i, f"an internationalizationword{'abcdefgh'[i % 8]}{'abcdefgh'[i // 8 % 8]} here") for i in range(1000)]
    secret = [(2000 + i, f"token = {turned(i)}") for i in range(4)]
    found = secret_scan.scan(docs_of(spark, plain + secret)).collect()
    assert {r.doc_id for r in found if r.is_secret} == {i for i, _ in secret}
    mixed = [(3000, "see commit 0f1e2d3c4b5a69788796a5b4c3d2e1f0 there")]
    only = secret_scan.scan(docs_of(spark, secret + mixed)).collect()
    assert {r.doc_id for r in only if r.is_secret} == {i for i, _ in secret}


def test_phones_of_other_countries_and_dates_month_first(spark):
    phones = ["+44 20 7946 0958", "+33 1 23 45 67 89", "+49 30 12345678", "+34 612 345 678", "555 123 4567", "+49 (0)30 1234567", "+4915112345678"]
    texts = [(i, f"call {p} now", "src") for i, p in enumerate(phones)]
    rows = pii.pseudonymise(docs_of(spark, [x[:2] for x in texts]), "k").collect()
    for r in rows:
        assert r.pii_phone == 1 and phones[r.doc_id] not in r.text
        assert re.sub(r"\d", "0", r.text) == re.sub(r"\d", "0", texts[r.doc_id][1])
    dates = [f"{m:02}/{d:02}/{y}" for y in (1999, 2004) for m in range(1, 13) for d in (1, 7, 13, 28)]
    got = [r.text for r in pii.pseudonymise(docs_of(spark, [*enumerate(dates), (999, "02/30/2001")]), "k").orderBy("doc_id").collect()]
    assert got.pop() == "02/30/2001" and len(set(got)) == len(dates) and not set(got) & {"12/28/1999"}
    assert all((int(new[3:5]) > 12) == (int(old[3:5]) > 12) and new != old for new, old in zip(got, dates))


def replaced(length):
    """Every choice of as many places as may differ in an item of this length."""
    most = max(k for k in range(length) if length - k >= contamination.SHARE * length)
    return itertools.combinations(range(length), most)


def test_masks_cover_items_of_every_length():
    for n in range(contamination.SHORTEST, contamination.OVERLAP + 1):
        for gone in replaced(n):
            assert any(all(m[k - at:k - at + 1] != "1" or k < at for k in gone)
                       for m in contamination.masks_for(n) for at in range(n - len(m) + 1))


def test_short_items_leak_with_replaced_words(spark):
    words = {n: [f"item{n}word{i}" for i in range(n)] for n in range(4, 13)}
    texts, expected = [], set()
    for n, item in words.items():
        for gone in replaced(n):
            text = "x y " + " ".join("other" if k in gone else w for k, w in enumerate(item)) + " z"
            texts.append((len(texts), text))
            if n >= contamination.SHORTEST:
                expected.add((len(texts) - 1, n))
    texts.append((len(texts), " ".join("other" if k < 3 else w for k, w in enumerate(words[12]))))
    bench = spark.createDataFrame([(n, " ".join(w)) for n, w in words.items()], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in contamination.leaks(docs_of(spark, texts), bench).collect()} == expected


@pytest.mark.parametrize("text", [
    "a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y z.", "<|endoftext|>first word", "one  <|endoftext|>\n<|endoftext|><|endoftext|> two ", "plain <|endoftext| > text"])
def test_literals_of_added_tokens_have_their_ids(text):
    from tokenizers import Tokenizer

    expected = Tokenizer.from_file(packing.TOKENIZER).encode(text, add_special_tokens=False).ids
    other = Tokenizer.from_file(packing.TOKENIZER).encode("more text here", add_special_tokens=False).ids
    ids, begins = packing.Encoder(packing.TOKENIZER).encode(pa.array([text, "more text here"]))
    assert ids.tolist() == [*expected, packing.END_ID, *other, packing.END_ID] and begins.tolist() == [0, len(expected) + 1, len(ids)]


def test_a_domain_of_many_labels_is_one_mail_address(spark):
    long = "a@" + "b." * 100_000 + "c"
    rows = pii.pseudonymise(docs_of(spark, [(1, f"write {long} now"), (2, "a@" + "." * 100_000), (3, "x" * 100_000 + "@h.example")]), "k").collect()
    got = {r.doc_id: r for r in rows}
    assert re.fullmatch(r"write u[0-9a-f]{16}@pseudonym\.invalid now", got[1].text) and got[1].pii_mail == 1
    assert got[2].pii_mail == 0 and got[3].pii_mail == 0


def test_country_codes_stay(spark):
    phones = ["+34 612 345 678", "+1 (555) 123-4567", "+358 40 1234567", "+7 495 123 45 67", "+44 20 7946 0958", "+1 555 123 4567"]
    rows = pii.pseudonymise(docs_of(spark, enumerate(phones)), "k").collect()
    for r in rows:
        assert r.text != phones[r.doc_id] and re.sub(r"\d", "0", r.text) == re.sub(r"\d", "0", phones[r.doc_id])
        assert r.text.split()[0] == phones[r.doc_id].split()[0]
    digits = {r.doc_id: re.sub(r"\D", "", r.text) for r in rows}
    assert digits[1] == digits[5]  # the same number in two layouts


def test_columns_of_the_input_stay_as_they_are(spark):
    df = spark.createDataFrame([(1, f"mail a@h.example token={SECRET}", "f", "c", "i")], "doc_id long, text string, found string, CHANGES string, secret_at string")
    out = pii.pseudonymise(df, "k").collect()[0]
    assert (out.found, out.CHANGES, out.pii_mail) == ("f", "c", 1)
    red = secret_scan.redact(df, secret_scan.scan(df)).collect()[0]
    assert red.secret_at == "i" and red.text == "mail a@h.example token=<secret>"


def test_a_candidate_of_a_megabyte_is_scored(spark):
    r = random.Random(1)
    long = "".join(r.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJ0123456789+/") for _ in range(1_000_000))
    rows = secret_scan.scan(docs_of(spark, [(1, f"data:image/png;base64,{long}"), (2, f"token={SECRET}"), (3, "a" * 1_000_000)])).collect()
    assert {r.doc_id: len(r.value) for r in rows} == {1: len(long), 2: len(SECRET), 3: 1_000_000}
    by_hand = [long.lower()[i:i + 4] for i in range(50)]
    df = spark.createDataFrame([(long[:53], "ab", "\U0001f600bcde")], "a string, b string, c string")
    got = df.select(*(secret_scan.pieces(df[c]).alias(c) for c in "abc")).collect()[0]
    assert (got.a, got.b, got.c) == (by_hand, ["ab"], ["\U0001f600bcd", "bcde"])
