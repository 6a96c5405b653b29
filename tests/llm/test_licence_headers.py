"""Licence notices as they stand in source files: wrapped, commented, two at a time."""

from __future__ import annotations

import random
import textwrap

import pytest

from gantry.llm import licenses

from .cases import prose


@pytest.fixture(scope="module")
def model():
    rng = random.Random(4)
    return licenses.train([prose(25, rng).encode().split() for _ in range(400)])


def found(model, text: str):
    ((count, rows),) = licenses.scan([text.encode()], model, licenses._Numbers(model.words))
    return count, rows


LONG = [(f, n) for f, notices in licenses.NOTICES.items() for n in notices if len(n.split()) > 15]


@pytest.mark.parametrize("mark", ["", "# ", " * ", "// "])
def test_wrapped_headers(model, mark):
    rng = random.Random(6)
    assert {f for f, _ in LONG} >= {"mit", "gpl", "bsd", "apache-2.0"}
    for family, notice in LONG:
        lines = [mark + line for line in textwrap.wrap(notice, 36)]
        for before in ([], [mark.strip(), mark + prose(6, rng)], [prose(40, rng), ""]):
            _, rows = found(model, "\n".join([*before, *lines, "", prose(30, rng)]))
            assert {f for _, f, _ in rows} == {family}, (family, rows)
            assert len(rows) == 1


def test_long_blocks_of_lines(model):
    rng = random.Random(7)
    for family, notice in LONG:
        lines = [*textwrap.wrap(prose(150, rng), 60), *textwrap.wrap(notice, 50), *textwrap.wrap(prose(90, rng), 60)]
        assert {f for _, f, _ in found(model, "\n".join(lines))[1]} == {family}


def test_two_families_in_a_paragraph(model):
    text = "Licensed under the Apache License, Version 2.0. Released under the MIT License."
    assert {f for _, f, _ in found(model, text)[1]} == {"apache-2.0", "mit"}


def test_similar_notices_are_one_family(model):
    for family, notices in licenses.NOTICES.items():
        for notice in notices:
            assert {f for _, f, _ in found(model, notice)[1]} == {family}, notice


def test_longest_notice_fits_a_stretch():
    assert max(len(n.split()) for notices in licenses.NOTICES.values() for n in notices) <= licenses.STRETCH // 2
