"""Accounts that numbers follow, and phones without a plus sign."""

import re

import pytest

from llm.test_cleaning import changed
from tracewright.llm import pseudonyms

ACCOUNTS = ["ES9121000418450200051332", "ES91 2100 0418 4502 0005 1332", "AT61 1904 3002 3457 3201", "SE45 5000 0000 0583 9825 7466", "CZ6508000000192000145399", "DE89 3704 0044 0532 0130 00", "NO93 8601 1117 947", "FR14 2004 1010 0505 0001 3M02 606", "BE68539007547034", "GB29NWBK60161331926819"]


def valid(account):
    account = account.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


@pytest.mark.parametrize("tail", ["", " EUR 50", " 2024-01-02", " 12", " A1", " ABC,", ".", " 4111111111111111", " ES9121000418450200051332"])
def test_accounts_end_where_their_country_says(spark, tail):
    got = changed(spark, *(f"to {a}{tail}" for a in ACCOUNTS))
    (alone,) = changed(spark, "x" + tail)
    for old, new in zip(ACCOUNTS, got, strict=True):
        shown = new[3 : 3 + len(old)]
        assert valid(old) and valid(shown) and shown != old and re.sub("[0-9]", "0", shown)[4:] == re.sub("[0-9]", "0", old)[4:]
        assert new[3 + len(old) :] == alone[1:]


def test_accounts_of_other_countries_end_where_their_check_digits_hold(spark):
    a = "XX00 1234 5678 9012"
    a = next(x for x in (a.replace("00", f"{c:02}", 1) for c in range(2, 99)) if valid(x))
    for tail in ("", " EUR", " 2024", " 2024 AB"):
        (got,) = changed(spark, a + tail)
        assert got[: len(a)] != a and valid(got[: len(a)]) and got[len(a) :] == tail


def test_accounts_are_as_long_as_the_table_says():
    countries = [c for names in pseudonyms.ACCOUNTS.values() for c in names.split()]
    assert len(countries) == len(set(countries))
    assert all(len(a.replace(" ", "")) in [n for n, names in pseudonyms.ACCOUNTS.items() if a[:2] in names.split()] for a in ACCOUNTS)


def test_phones_without_a_plus_sign(spark):
    old = ["1-800-555-1234", "1-415-555-2671", "555 123 4567", "1 415 555 2671", "1.415.555.2671", "1 (415) 555-2671", "1-415-555-2671 12"]
    for before, after in zip(old, changed(spark, *(f"call {x} now" for x in old)), strict=True):
        assert after != f"call {before} now" and re.sub("[0-9]", "0", after) == re.sub("[0-9]", "0", f"call {before} now")
    stay = ["555 123 45678", "1-2-3", "12-800-555-1234-5", "v1.415.555.2671.3"]
    assert changed(spark, *stay) == stay


def test_numbers_behind_what_is_no_account(spark):
    """Order, case and room numbers look like the beginning of an account."""
    codes = ["", "AB12 ", "ID12 ", "UK07 DATA ", "DE89 ", "GB29 NWBK ", "XX00 1234 5678 ", "NO93 "]
    numbers = ["4111 1111 1111 1111", "4012888888881881", "5555-5555-5555-4444", "123-45-6789", "+1 415 555 2671", "ES91 2100 0418 4502 0005 1332", "ES9121000418450200051332", "10.20.30.40", "2024-01-02"]
    cases = [(c, n) for c in codes for n in numbers]
    got = dict(zip(cases, changed(spark, *(f"is {c}{n} so" for c, n in cases)), strict=True))
    for (code, number), new in got.items():
        alone = got["", number]
        assert alone != f"is {number} so" and new == alone.replace("is ", f"is {code}", 1), (code, number)


def test_numbers_beside_and_across_others(spark):
    card, across, failing = "4111 1111 1111 1111", "AB12 3456 7890 123-45-6789 and AB12 3456 7890 4111 1111 1111 1111", ["DE88 3704 0044 0532 0130 00", "AB12 CDEF GHIJ KLMN", "XX00 1234 5678 9012 x"]
    before, after = ["room 1234 ", "1234 5678 ", "no. 12 ", "(", "2024 "], ["", " 1234", " 12/27", ".", " 123"]
    beside = [f"{b}{card}{a}" for b in before for a in after]
    new, crossed, *rest = changed(spark, card, across, *failing, *beside)
    assert rest[: len(failing)] == failing
    assert rest[len(failing) :] == [x.replace(card, new) for x in beside]
    assert re.sub("[0-9]", "0", crossed) == re.sub("[0-9]", "0", across) and crossed[:15] == across[:15] and crossed[15:26] != across[15:26] and crossed[46:] != across[46:]
