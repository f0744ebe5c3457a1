"""Identifiers and secrets after cues in plain forms, and prose with the same words."""

import pytest

from waymark.llm import pii


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("account number: 12345678", "12345678"),
        ("account no. 12345678", "12345678"),
        ("Passport No: X1234567", None),
        ("passport no: X12345678", "X12345678"),
        ("my SSN is 123-45-6789.", "123-45-6789"),
        ("password: correct-horse-battery", "correct-horse-battery"),
        ('"password" = "p4ssWord!x"', "p4ssWord!x"),
        ("api_key=sk_live_abcdEFGHijkl", "sk_live_abcdEFGHijkl"),
        ("API key: abcd1234efgh", "abcd1234efgh"),
        ("apiKey = abcd1234efgh", "abcd1234efgh"),
        ("API_key=abcd1234efgh", "abcd1234efgh"),
        ("IBAN number: DE89 3704 0044 0532 0130 00 x", "DE89 3704 0044 0532 0130 00"),
    ],
)
def test_cue_forms(text, found):
    found = found or "X1234567"
    assert [text[a:b] for k, a, b in pii.find_spans(text) if k == "account"] == [found]
    assert found not in pii.redacted(text, pii.find_spans(text)) and pii.redacted("é\u0130 " + text, pii.find_spans("é\u0130 " + text)) == "é\u0130 " + text.replace(found, "[ACCOUNT]")


@pytest.mark.parametrize("text", ["The account is closed for good.", "a token of gratitude", "The secret: everything", "password is required", "Password: required", "no passport number is needed here", "on account of the well-known weather", "api key documentation", "accountability: none whatsoever", "the secret is well-hidden", "account number"])
def test_clean_prose(text):
    assert pii.find_spans(text) == []
