"""Value texts: what is written down is what is read."""

from hypothesis import given
from hypothesis import strategies as st

from sieveframe.functions.values import ValueTextError, parse_list, parse_mask_number, parse_range

blank = st.sampled_from(["", " ", "  ", "\t"])
item = st.text(st.characters(min_codepoint=33, exclude_characters="(),[]*"), min_size=1, max_size=8).filter(
    lambda s: s.strip() == s and s != "TO"
)
longs = st.integers(-(2**63), 2**63 - 1)


@given(st.lists(item, min_size=1, max_size=6), blank)
def test_lists(items, pad):
    assert parse_list(f"{pad}({f'{pad},{pad}'.join(items)}){pad}") == items


@given(item, item, st.booleans(), st.booleans(), blank)
def test_ranges(low, high, closed_low, closed_high, pad):
    text = f"{pad}{'[' if closed_low else '('}{low} TO {high}{']' if closed_high else ')'}{pad}"
    read = parse_range(text)
    assert (read.lower, read.upper, read.include_lower, read.include_upper) == (low, high, closed_low, closed_high)


@given(longs)
def test_numbers(n):
    sign, size = ("-" if n < 0 else ""), abs(n)
    assert parse_mask_number(str(n)) == parse_mask_number(f"0x{sign}{size:x}") == parse_mask_number(f"0b{sign}{size:b}") == n


@given(st.integers(2**63, 2**70))
def test_too_large(n):
    for text in (str(n), hex(n), bin(n)):
        try:
            parse_mask_number(text)
        except ValueTextError:
            continue
        raise AssertionError(text)
