"""Token-sort similarity of two texts on a 0 to 100 scale, inside the JVM.

The functions take column names: these expressions nest too deeply to be built call by call.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from regiostar.functions.text import SPACE_CLASS

# Positions that fit the bits of one long with room for the carry.
WORD_BITS = 61


def sorted_tokens(col: Column) -> Column:
    """Words in code point order, joined by one blank."""
    words = F.filter(F.split(col, rf"(?U){SPACE_CLASS}+"), lambda w: w != "")
    return F.array_join(F.array_sort(words), " ")


def position_masks(text: str) -> Column:
    """For each character of a text the set of its positions as bits: ``few`` is one number for a text of at most
    WORD_BITS characters, ``many`` one number for each WORD_BITS characters of a longer one."""
    few = f"""
        CASE WHEN length({text}) BETWEEN 1 AND {WORD_BITS} THEN
            map_from_entries(transform(
                array_distinct(split({text}, '')),
                c -> struct(c, aggregate(
                    sequence(1, length({text})), 0L,
                    (bits, i) -> IF(substring({text}, i, 1) = c, bits | shiftleft(1L, i - 1), bits)))))
        END"""
    # The characters are bound once by a transform over an array of one array.
    many = f"""
        CASE WHEN length({text}) > {WORD_BITS} THEN
            transform(array(split({text}, '')), chars -> map_from_entries(transform(
                array_distinct(chars),
                c -> struct(c, transform(
                    sequence(0, cast(ceil(size(chars) / {WORD_BITS}) AS int) - 1),
                    w -> aggregate(
                        slice(chars, w * {WORD_BITS} + 1, {WORD_BITS}), named_struct('bits', 0L, 'at', 1L),
                        (s, x) -> named_struct('bits', IF(x = c, s.bits | s.at, s.bits), 'at', s.at * 2L),
                        s -> s.bits))))))[0]
        END"""
    return F.struct(F.expr(few).alias("few"), F.expr(many).alias("many"))


def _common_by_bits(left: str, right: str, masks: str) -> str:
    """Longest common subsequence, one step per character: a cleared bit marks a matched position."""
    ones = f"(shiftleft(1L, length({right})) - 1L)"
    hit = f"(state & coalesce({masks}.few[c], 0L))"
    return f"""length({right}) - bit_count(aggregate(
        split({left}, ''), {ones}, (state, c) -> ((state + {hit}) | (state - {hit})) & {ones}))"""


def _common_by_words(left: str, right: str, masks: str) -> str:
    """The same over several words of WORD_BITS bits: a step per character and word, the sum's carry goes to the next word.

    Characters that the right text lacks change nothing and are left out. Bits beyond the right text stay set.
    """
    ones, words = (1 << WORD_BITS) - 1, f"cast(ceil(length({right}) / {WORD_BITS}) AS int)"
    return f"""{words} * {WORD_BITS} - aggregate(
        transform(filter(split({left}, ''), c -> map_contains_key({masks}.many, c)), c -> {masks}.many[c]),
        array_repeat({ones}L, {words}),
        (state, mask) -> aggregate(
            zip_with(state, mask, (v, m) -> named_struct('v', v, 'hit', v & m)),
            named_struct('done', cast(array() AS array<bigint>), 'carry', 0L),
            (s, x) -> named_struct(
                'done', array_append(s.done, ((x.v + x.hit + s.carry) & {ones}L) | (x.v - x.hit)),
                'carry', shiftright(x.v + x.hit + s.carry, {WORD_BITS})),
            s -> s.done),
        state -> aggregate(state, 0, (n, v) -> n + bit_count(v)))"""


def indel_ratio(left: str, right: str, masks: str) -> Column:
    """100 · 2·LCS / (sum of lengths) of two columns; ``masks`` holds the position masks of the right one."""
    return F.expr(f"""
        CASE WHEN {left} IS NULL OR {right} IS NULL THEN NULL
             WHEN {left} = '' AND {right} = '' THEN 100.0D
             WHEN {left} = '' OR {right} = '' THEN 0.0D
             WHEN length({right}) <= {WORD_BITS}
             THEN 200.0D * ({_common_by_bits(left, right, masks)}) / (length({left}) + length({right}))
             ELSE 200.0D * ({_common_by_words(left, right, masks)}) / (length({left}) + length({right})) END""")
