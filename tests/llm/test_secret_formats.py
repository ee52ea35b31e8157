"""Candidates against several learnt formats, and beside base matches."""

import random

from postsift.llm import secret_scan

TIGHT = "ABCDEFGHJKLMNPQR0123456789"
WORDS = ["ordinaryprosewords", "considerations", "notwithstanding"] * 30


def made(rng, chars, n, head=""):
    return head + "".join(rng.choices(chars, k=n))


def test_one_of_several_formats_is_enough():
    rng = random.Random(5)
    tight = [made(rng, TIGHT, 18, "XQ7-") for _ in range(200)]
    # Values of every kind: a low floor that nearly all candidates exceed.
    mixed = [made(rng, "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_.=-", rng.randint(12, 60)) for _ in range(200)]
    mixed += ["=" * 12, "/+" * 6 + "._=-" * 5]
    formats = secret_scan.Formats({0: mixed, 1: tight}, WORDS)
    wide, narrow = formats.automata
    found = 0
    for _ in range(50):
        text = made(rng, TIGHT, 18, "XQ7-")
        rate = narrow.per_symbol(text)
        if rate >= narrow.floor and rate - formats.ordinary(text) >= secret_scan.MARGIN:
            assert formats.secret(text)
            # The wide format has the larger surplus and misses the margin.
            found += (wide.per_symbol(text) - wide.floor > rate - narrow.floor
                      and wide.per_symbol(text) - formats.ordinary(text) < secret_scan.MARGIN)
    assert found


def test_rest_of_a_token_around_a_base_match():
    rng = random.Random(6)
    # Tokens of hex digits between capitals: the digits alone are a base match.
    token = lambda: made(rng, TIGHT, 10, "XQ7-") + made(rng, "0123456789abcdef", 18) + made(rng, TIGHT, 10)
    formats = secret_scan.Formats({0: [token() for _ in range(200)]}, WORDS)
    text = f"see {token()} here"
    spans = formats.spans(text)
    assert {k for _, _, k in spans} == {2, 3}
    assert secret_scan.masked(text, spans) == "see [SECRET] here"
    whole = "password=" + "0123456789abcdef" * 2
    assert [k for _, _, k in formats.spans(whole)] == [0, 2]
