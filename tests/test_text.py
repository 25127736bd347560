import random
import re
import unicodedata

import pytest

from tastegrid.functions import text

ALPHABET = "aB é\t\n\x0b\x1c\x85\xa0 　,&[]{}<>\"'`/_|+-09Zz東ß.;"


def random_texts(n=400, seed=7):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(0, 14))) for _ in range(n)]


def plain_name(t):
    """Definition, step by step, over characters."""
    words = t.strip().lower()
    spaced, blank = [], False
    for ch in words:
        if ch.isspace():
            if not blank:
                spaced.append(" ")
            blank = True
        else:
            spaced.append(ch)
            blank = False
    return "".join(ch for ch in spaced if " " <= ch <= "~")


def test_name_edges(values):
    assert values(text.normalize_text, ["  A  é  B ", "東京", None, " x  y "]) == ["a  b", "", None, "x y"]


def test_name_matches_definition(values):
    items = random_texts()
    assert values(text.normalize_text, items) == [plain_name(t) for t in items]


def test_composer_flip(values):
    items = ["Bach, J. S.", "Bach,", "a, b, c", " Plain  Name ", ",x", ", "]
    assert values(text.normalize_composer, items) == ["j. s. bach", "bach", "b, c a", "plain name", "x", ""]


def test_tag_edges(values):
    items = ["R&B", "hip_hop/rap", "[lo-fi]", "C++", "é", None, "  A | b  "]
    assert values(text.normalize_tag, items) == ["r and b", "hip hop rap", "lo-fi", "c++", "", "", "a b"]


def test_tag_is_idempotent_and_plain(values):
    once = values(text.normalize_tag, random_texts(seed=8))
    assert values(text.normalize_tag, once) == once
    assert all(set(t) <= set("abcdefghijklmnopqrstuvwxyz0123456789+- ") for t in once)
    assert all(t == " ".join(t.split()) for t in once)


def test_tokens(values):
    got = values(text.tokens, ["c++ lo-fi hip hop +44 rock+roll rock- a"])
    assert got == [["c", "lo-fi", "hip", "hop", "44", "rock+roll", "rock", "a"]]


def test_tokens_of_tags_are_tokens_of_joined_text(values):
    tags = [t for t in values(text.normalize_tag, random_texts(seed=9)) if t]
    apart = [w for t in values(text.tokens, tags) for w in t]
    assert apart == values(text.tokens, [" ".join(tags)])[0]


def test_distinct_in_order(values):
    got = values(text.distinct_in_order, [["b", "", "a", "b", None]], "array<string>")
    assert got == [["b", "a"]]


def test_cache_key(values):
    assert values(text.cache_key, [" AbC ", "  "]) == ["abc", ""]


def test_feature_names():
    assert text.feature_names(["lo-fi", "rock+roll"]) == {"lo-fi": "tfidf_lo_fi", "rock+roll": "tfidf_rockplusroll"}
    with pytest.raises(ValueError, match="collide"):
        text.feature_names(["a+b", "aplusb"])


def test_whitespace_class_is_what_python_strips(values):
    spaces = [chr(c) for c in range(0x110000) if chr(c).isspace()]
    assert values(text.squeeze, [s + "x" + s for s in spaces]) == ["x"] * len(spaces)
    assert all(unicodedata.category(s) in ("Zs", "Zl", "Zp", "Cc") for s in spaces)
    assert not re.search("x", "".join(spaces))
