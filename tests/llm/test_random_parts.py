"""Random strings of one case, and as part of longer runs."""

from __future__ import annotations

import random
import string

import pytest

from gantry.llm import secrets

MIXED = string.ascii_letters + string.digits


def spans(text: str):
    encode = secrets.encoder(secrets.VOCABULARY).encode_ordinary
    return [text[a:b] for a, kind, b in secrets.scan(text, encode, secrets.MAX_CHARS_PER_TOKEN)[1] if kind == "random"]


@pytest.mark.parametrize("alphabet", [string.ascii_lowercase, string.ascii_uppercase])
def test_letters_of_one_case(alphabet):
    rng = random.Random(1)
    keys = ["".join(rng.choices(alphabet, k=32)) for _ in range(200)]
    assert sum(spans(f"see {key} now") == [key] for key in keys) >= 190


@pytest.mark.parametrize("before", ["/services/production/webhooks/notifications/", "database_connection_string=", "the-name_of_a-thing/"])
def test_keys_within_runs(before):
    rng = random.Random(2)
    keys = ["".join(rng.choices(MIXED, k=24)) for _ in range(200)]
    whole = [spans(f"see {before}{key}/administration/configuration now") for key in keys]
    assert sum(any(key in found for found in of_key) for key, of_key in zip(keys, whole)) >= 190


def test_two_keys_and_keys_with_separators():
    rng = random.Random(3)
    one, other = ("".join(rng.choices(MIXED, k=30)) for _ in range(2))
    assert spans(f"/internationalization/{one}/organization/configuration/{other}/notifications/administration") == [one, other]
    split = one[:11] + "/" + one[11:21] + "-" + one[21:]
    (found,) = spans(f"/internationalization/organization/configuration/notifications/{split}")
    assert split in found


def test_digests_and_identifiers_within_runs():
    digest = "d41d8cd98f00b204e9800998ecf8427e".upper()
    for clean in (
        f"/objects/understanding/documents/{digest}/configuration/information",
        "/organization/documents/123E4567-E89B-12D3-A456-426614174000/information/configuration",
        "/articles/2024/01/02/13/45/20240102134501/understanding-large-documents",
        "https://example.com/2024/11/05/some-of-the-best-documents-about-training",
        "to_whom_it_may_concern_regarding_information",
        "Donaudampfschifffahrtsgesellschaft",
    ):
        assert not spans(f"a {clean} b"), clean


def test_long_runs_take_linear_time():
    assert spans("information/" * 20000) == []
