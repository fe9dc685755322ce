"""Further formats of personal data: found, exchanged within their form, linked, and undone."""

import pytest

from framewell.llm import pii
from framewell.llm.queries import TEST_KEY

FOUND = [
    ("card", "3782 822463 10005"), ("phone", "1-800-555-1234"), ("phone", "555 323 4567"), ("date", "2021/03/04"), ("date", "03/04/21"),
    ("date", "25/12/99"), ("iban", "DE89 3704 0044 0532 0130 00"), ("iban", "GB82WEST12345698765432"), ("ipv6", "2001:db8::ff00:42:8329"),
    ("ipv6", "2001:0DB8:0000:0000:0000:FF00:0042:8329"), ("email", "m\u00fcller@example.com"), ("email", "\u043c\u0430\u0440\u0438\u044f@example.com"),
    ("ssn", "123 45 6789"), ("email", "l@example.com"), ("email", "w@example.com"),
]


@pytest.mark.parametrize(("kind", "value"), FOUND)
def test_format_is_kept_and_can_be_undone(kind, value):
    text, found = pii.replaced(f"Write to {value} AND see.", TEST_KEY)
    assert found == [(kind, 9, 9 + len(value))]
    new = text[9 : 9 + len(value)]
    assert text == f"Write to {new} AND see." and new != value
    assert pii.pseudonym(kind, new, TEST_KEY, back=True) == value
    assert pii.replaced(f"Write to {new} AND see.", TEST_KEY)[1] == found  # valid in its turn
    assert [c.isalnum() for c in new] == [c.isalnum() for c in value]


@pytest.mark.parametrize("text", ["DE88 3704 0044 0532 0130 00", "at 12:34:56 or 1:2:3", "std::vector::size", "3782 822463 10006", "13/13/21", "2021/02/30", "000 12 3456", "cafe::bad::c"])
def test_what_is_not_valid_stays(text):
    assert pii.replaced(text, TEST_KEY) == (text, [])


@pytest.mark.parametrize("size", [2, 3, 26, 1000])
def test_no_value_is_its_own_image(size):
    assert all(pii.permuted(i, size, TEST_KEY, "t") != i for i in range(size))
