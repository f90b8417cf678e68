import pytest

from docloom.functions import text as t


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("a<figure>x\ny</figure>b", "ab"),
        ("a<figure>x</figure>m<figure>y</figure>b", "amb"),
        ("a<figure>never closed", "a<figure>never closed"),
        ('a<img\nsrc="data:image/gif;base64,R0" alt="q">b', "ab"),
        ('a<img src="x.png">b', 'a<img src="x.png">b'),
        ("![a](x.png) kept", "![a](x.png) kept"),
        ("a ![i](data:image/png;base64,AA==) b", "a  b"),
        ("see {prod-name} and {x}", "see  and "),
        ("{1} {-a} {a b} {} {ä}", "{1} {-a} {a b} {} {ä}"),
        ("{aü_9-}", ""),
        ("plain text", "plain text"),
        # The reference to remove may only come together by another removal.
        ("{a<figure>x</figure>b}", ""),
    ],
)
def test_clean_technical(value, raw, expected):
    assert value(t.clean_technical, raw) == expected


def test_clean_takes_ordinary_image_and_words_by_default(value):
    line = "![a](x.png) ![b](data:image/png;base64,AA==) end"
    assert value(t.clean_technical, line) == " end"
    assert value(lambda c: t.clean_technical(c, strict=True), line) == "![a](x.png)  end"
    bare = "x data:image/png;base64,QUJD\nlost words. kept"
    assert value(t.clean_technical, bare) == "x . kept"
    assert value(lambda c: t.clean_technical(c, strict=True), bare) == "x \nlost words. kept"


def test_markdown_image_does_not_cross_lines(value):
    text = "![a\n](data:image/png;base64,AA;)"
    assert value(t.drop_markdown_data_images, text) == text
    # A carriage return or a line separator does not end a line.
    assert value(t.drop_markdown_data_images, "![a b\r](data:image/x)") == ""


@pytest.mark.parametrize("code", [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1F, 0x20, 0x85, 0xA0, 0x1680, 0x2003, 0x2028, 0x3000])
def test_strip_knows_all_white_space(value, code):
    space = chr(code)
    assert value(t.strip, f"{space} a{space}b {space}") == f"a{space}b"
    assert value(t.is_blank, space * 3) is True


def test_strip_leaves_other_characters(value):
    assert value(t.strip, "​ a ﻿") == "​ a ﻿"
    assert value(t.is_blank, " ​") is False


def test_newlines(value):
    assert value(t.normalise_newlines, "a\r\nb\rc\n") == "a\nb\nc\n"


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("<think>a\nb</think> yes", "yes"),
        ("<reasoning>r</reasoning><reflection>s</reflection>x\n", "x"),
        ("<think>x</reasoning>y", "<think>x</reasoning>y"),
        ("<think>a<think>b</think>c</think>d", "c</think>d"),
        ("<Think>a</Think>b", "<Think>a</Think>b"),
        ("<think >a</think>", "<think >a</think>"),
        ("<think>open", "<think>open"),
        ("<think>only</think>", ""),
        ("  no trace ", "no trace"),
        (None, None),
    ],
)
def test_strip_reasoning(value, raw, expected):
    assert value(t.strip_reasoning, raw) == expected


def test_null_if_missing(value):
    assert value(t.null_if_missing, "") is None
    assert value(t.null_if_missing, "NA") == "NA"
    assert value(lambda c: t.null_if_missing(c, ("NA",)), "NA") is None
