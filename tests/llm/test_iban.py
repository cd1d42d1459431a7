"""IBANs that are followed by what looks like more of them."""

import pytest

from barpath.llm import pii


@pytest.mark.parametrize(
    ("text", "iban"),
    [
        ("DE89 3704 0044 0532 0130 00 BIC COBADEFF", "DE89 3704 0044 0532 0130 00"),
        ("DE89370400440532013000 2024", "DE89370400440532013000"),
        ("GB82 WEST 1234 5698 7654 32 AND", "GB82 WEST 1234 5698 7654 32"),
        ("DE89370400440532013000 GB82WEST12345698765432", "DE89370400440532013000"),
        ("MT84MALT011000012345MTLCAST001S EUR", "MT84MALT011000012345MTLCAST001S"),
    ],
)
def test_iban_before_upper_case(text, iban):
    found = [s for s in pii.spans(text) if s[0] == "iban"]
    assert text[found[0][1] : found[0][2]] == iban
    assert iban not in pii.redacted(text, pii.spans(text))
    assert len(found) == (2 if "GB82WEST" in text else 1)


def test_no_iban_of_a_wrong_checksum_or_length():
    for text in ("GB82 WEST 1234 5698 7654 33", "GB82 WEST 1234 5698 7654 33 AND", "DE8937040044053201300 0X", "DE89370400440532013000X"):
        assert not [s for s in pii.spans(text) if s[0] == "iban"]


def test_iban_of_a_country_without_a_known_length():
    assert "QQ" not in pii.IBAN_LENGTHS
    body = "BANK0123456789"
    code = f"QQ{98 - int(''.join(str(int(c, 36)) for c in body + 'QQ00')) % 97:02d}{body}"
    assert [code] == [f"{code} AND"[a:b] for kind, a, b, _ in pii.spans(f"{code} AND") if kind == "iban"]
