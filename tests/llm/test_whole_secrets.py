"""Novel secrets of any length and alphabet are found and masked whole."""

import random
import string as st

import pytest

from cases import frame, prose
from farpoint.llm import secrets

ALPHABETS = {"HEX": "0123456789ABCDEF", "base36": st.digits + st.ascii_lowercase,
             "digits": st.digits, "letters": st.ascii_letters, "base64": st.ascii_letters + st.digits + "+/"}


def around(rng, secret):
    return prose(rng, 60) + " bearer " + secret + " " + prose(rng, 60)


@pytest.mark.parametrize("n", [16, 33, 64, 128, 256, 257, 600, 5000])
@pytest.mark.parametrize("alphabet", ALPHABETS)
def test_random_strings_are_novel_whole(alphabet, n):
    rng = random.Random(n)
    novelty = secrets.Novelty(b"configuration_value secret_name")
    for _ in range(20):
        s = "".join(rng.choice(ALPHABETS[alphabet]) for _ in range(n))
        text = around(rng, s)
        # 32 digits and more are of the base kind hex
        spans = [(a, b) for a, _, b in secrets.scan(text, novelty)]
        assert spans == [(text.index(s), text.index(s) + n)]


def test_predicted_strings_are_not_novel():
    novelty = secrets.Novelty(b"configuration_value_name_for_production")
    rng = random.Random(1)
    for s in ("a1" * 40, "ab" * 400, "configuration_value_name_for_production"):
        assert not [x for x in secrets.scan(around(rng, s), novelty) if x[1] == 3]


def test_secret_with_a_base_span_inside_is_masked_whole(spark):
    rng = random.Random(4)
    s = "".join(rng.choice(ALPHABETS["base64"]) for _ in range(300)) + "+" + "0123456789abcdef" * 2 + "+"
    s += "".join(rng.choice(ALPHABETS["base64"]) for _ in range(300))
    text = around(rng, s)
    (out,) = secrets.redact(frame(spark, [(1, text, "en", "a")])).collect()
    assert out["text"] == text.replace(s, "[SECRET]")
