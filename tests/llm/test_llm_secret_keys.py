"""Keys that few digits, their alphabet, their length or line breaks could hide."""

import random
import string

import pytest

from parcelstream.llm import secrets

BASE62 = string.ascii_letters + string.digits
BASE64 = BASE62 + "+/"


def key(alphabet, length, seed):
    return "".join(random.Random(seed).choices(alphabet, k=length))


def found(text):
    return [text[a:b] for a, _, b in secrets.scan(text, secrets.Novelty())[1]]


@pytest.mark.parametrize("alphabet, length", [
    (BASE62, 16), (BASE62, 20), (BASE62, 24), (BASE62, 32), (string.ascii_letters, 20), (string.ascii_letters, 32),
    (string.digits + "ABCDEF", 64), (string.digits + "ABCDEF", 128), (BASE64, 64), (BASE64, 800),
    (BASE64, 1000), (BASE64, 5000), (BASE64, 20_000)])
def test_random_keys_are_found(alphabet, length):
    for seed in range(20):
        k = key(alphabet, length, seed)
        for cue in ("Bearer ", "the private "):
            assert found(f"{cue}{k} and more text") == [k], k


@pytest.mark.parametrize("alphabet", [string.ascii_lowercase, string.ascii_uppercase, string.digits,
                                      BASE62 + "!@#$%^&*"])
def test_keys_of_one_kind_of_character_and_of_symbols(alphabet):
    hits = 0
    for seed in range(40):
        for length in (16, 20, 23, 40):   # 24 digits and more are a base span
            k = key(alphabet, length, seed)
            base, more = secrets.scan(f"Bearer {k} and more text", secrets.Novelty())
            hits += [(a, b) for a, _, b in base + more] == [(7, 7 + length)]
    assert hits >= 0.97 * 160


def test_short_keys_and_distant_ones():
    short = [key(BASE62, n, s) for n in (12, 14) for s in range(40)]
    assert sum(found(f"Bearer {k} and more") == [k] for k in short) >= 0.97 * len(short)
    k = key(BASE62, 32, 3)
    for gap in (0, 50, 100, 120):
        assert found(f"the private {'- ' * (gap // 2)}{k} ok") == [k]
    assert found(f"the private {'- ' * 100}{k} ok") == []        # beyond REACH
    assert found(f"(Bearer {k})") == [k]


def test_words_dates_and_numbers_near_sensitive_words_are_not():
    for t in ("internationalization", "responsibilities", "Verantwortlichkeiten", "authentication",
              "datenschutzgrundverordnung", "2024-01-01T00:00:00", "20240101120000", "1704067200000",
              "+15551234567", "development-environment", "user@example.com", "a/path/to/some/file"):
        assert found(f"private {t} ok") == [], t


def test_identifiers_and_repeats_are_not():
    for t in ("getElementByIdFromDocument", "some_unusual_thingy_here", "org/example/orders/stream/Main",
              "CorrectHorseBatteryStaple", "PERSONAL_ACCESS_SETTINGS", "state-of-the-art-technology",
              "AbstractSingletonProxyFactoryBean", "abcd1234" * 1000, "-" * 30 + "a"):
        assert found(f"private {t} ok") == [], t


def test_hits_extend_over_token_lines():
    lines = [key(BASE64, 64, s) for s in range(6)] + [key(BASE62, 30, 9) + "=="]
    body = "\n".join(lines)
    text = f"-----BEGIN PRIVATE KEY-----\n{body}\n-----END PRIVATE KEY-----\n"
    assert found(text) == [body]
    assert found(text.replace("\n", "\r\n")) == [body.replace("\n", "\r\n")]
    assert found(f"Bearer {lines[0]}\nhello\nworld") == [lines[0]]
    assert found(f"Bearer {lines[0]}\ndocumentation_of_the_interface\n") == [lines[0]]
    assert found(f"Bearer {lines[0]}\n{'0123456789abcdef' * 2}\n") == [lines[0]]  # a base span stays


def test_part_of_a_long_token():
    k = key(BASE64, 8192, 1)
    assert found(f"Bearer {k + 'A' * 8192} x") == [k]
