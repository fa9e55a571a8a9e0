"""Untitled mentions, one gender in a text, and local phone numbers."""

from siftwell.llm import pii


def test_later_mentions_have_the_same_surrogate():
    text = "Dr Ivan Petrov came. Petrov said so, and Ivan Petrov left. Mr Ivan Petrov, IVAN, Mr. Petrov's; Petrovka ivan."
    out, kinds = pii.replace(text, b"k")
    first, last = out.split(" ")[1:3]
    last = last.rstrip(".")
    assert "Petrov " not in out and "Ivan" not in out and kinds == ["name"] * 6
    assert out == f"Dr {first} {last} came. {last} said so, and {first} {last} left. Mr {first} {last}, {first.upper()}, Mr. {last}'s; Petrovka ivan."
    assert pii.replace("Mr Ivan Petrov", b"k")[0] == f"Mr {first} {last}"


def test_local_phone_numbers():
    for number in ("743-555-3824", "743.555.3824", "743 555 3824", "030 1234567", "030/1234567", "(743) 555-3824", "+1 743 555 3824"):
        out, kinds = pii.replace(f"call {number}.", b"k")
        assert kinds == ["phone"] and number not in out and len(out) == len(number) + 6
    for other in ("123-45-6789", "10.20.30.40", "on 2024-05-06 at 12", "4111 1111 1111 1111"):
        assert "phone" not in pii.replace(f"see {other}.", b"k")[1]
