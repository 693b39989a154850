"""Conversation repair against brute force: all edit sequences of short ones, parsing over all splits, a plain version of the rest."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from crawlspark.llm import repair

ROWS = "text string, turn bigint, conv_id bigint, role string, place int, audit string, copy int"
GOOD = re.compile("(s?(ua)+)?")


def cells_of(rows):
    return (repair.LEXICON[row] for row in rows)


def cheapest_by_trying(rows, most=4):
    """All edits of all rows, and up to `most` insertions anywhere."""
    ways = []
    for initial, faulty, cut in rows:
        more = 3 if cut else 0
        ways.append([(4, "D", "")] + ([] if faulty else [(more, "K", initial or "x"), (3 + more, "R", "u"), (3 + more, "R", "a")]))
    best = None
    for edits in itertools.product(*ways):
        for count in range(most + 1):
            for gaps in itertools.combinations_with_replacement(range(len(rows) + 1), count):
                for added in itertools.product("ua", repeat=count):
                    parts, inserted = [], list(zip(gaps, added))
                    for place, edit in enumerate([*edits, None]):
                        parts += [("I", role) for gap, role in inserted if gap == place]
                        if edit:
                            parts.append(edit[1:])
                    if GOOD.fullmatch("".join(role for _, role in parts)):
                        found = sum(edit[0] for edit in edits) + 3 * count, "".join(edit for edit, _ in parts)
                        best = found if best is None else min(best, found)
    return best


def test_short_conversations_equal_all_edit_sequences():
    kinds = [("s", False, False), ("u", False, False), ("a", False, False), ("", False, False), ("u", True, False), ("a", False, True)]
    for length in range(4):
        for rows in itertools.product(kinds, repeat=length):
            assert repair.cheapest(repair.parsed(cells_of(rows))) == cheapest_by_trying(rows, 3), rows


def over_all_splits(rows):
    """The textbook form: every span, every split."""
    table = {(place, place + 1): cell for place, cell in enumerate(cells_of(rows))}
    for length in range(2, len(rows) + 1):
        for start in range(len(rows) - length + 1):
            cell = {}
            for middle in range(start + 1, start + length):
                for key, (cost, audit) in repair.joined(table[start, middle], table[middle, start + length]).items():
                    repair.better(cell, key, cost, audit)
            table[start, start + length] = cell
    return table.get((0, len(rows)))


def random_rows(dice, count):
    return [(dice.choice("ssuuuaaa") if dice.random() < 0.9 else "", dice.random() < 0.1, dice.random() < 0.2) for _ in range(count)]


def test_one_split_of_a_span_does():
    dice = random.Random(13)
    for _ in range(150):
        rows = random_rows(dice, dice.randrange(1, 16))
        assert repair.parsed(cells_of(rows)) == over_all_splits(rows)


def damage(rows):
    for row in rows:
        known = ["" if value is None else value for value in (row.role, row.text)]
        role, text = [" " if value is None else known[n] for n, value in enumerate((row.role, row.text))]
        way = zlib.crc32(f"{' ' if row.conv_id is None else row.conv_id}:{' ' if row.turn is None else row.turn}".encode()) % 20
        if way:
            text = "" if way == 1 else re.sub("[.!?]", "", text) if way == 2 else text
            yield from [(row.conv_id, row.turn, "user" if way == 4 else role, text)] * (2 if way == 3 else 1)


def step_by_step(rows):
    """Least (cost, audit) per state, one row after the other."""
    def with_insertions(cell):
        cell = dict(cell)
        for _ in range(3):
            for p, (cost, audit) in list(cell.items()):
                for step in (repair.STEPS["u"], repair.STEPS["a"]):
                    if p in step:
                        cell[step[p]] = min(cell.get(step[p], (1 << 40, "")), (cost + 3, audit + "I"))
        return cell

    cell = {0: (0, "")}
    for initial, faulty, cut in rows:
        after = {}
        for p, (cost, audit) in with_insertions(cell).items():
            moves = [(p, 4, "D")]
            if not faulty:
                moves += [(step[p], kind + 3 * cut, edit) for step, kind, edit in (
                    (repair.STEPS.get(initial, {}), 0, "K"), (repair.STEPS["u"], 3, "R"), (repair.STEPS["a"], 3, "R")) if p in step]
            for q, more, edit in moves:
                after[q] = min(after.get(q, (1 << 40, "")), (cost + more, audit + edit))
        cell = after
    return min(found for q, found in with_insertions(cell).items() if q in (0, 3))


def expected(rows):
    found = {row.conv_id: [] for row in rows}
    for row in damage(rows):
        found[row[0]].append(row[1:])
    results = {}
    for conv_id, said in found.items():
        said.sort(key=lambda row: (row[0] is not None, row[0] or 0, row[1]))
        turns = [turn for turn, _, _ in said if turn is not None]
        counts, kinds, seen = dict.fromkeys(("blank", "duplicate", "truncated"), 0), [], set()
        for _, role, text in said:
            last = re.sub(r"[\x20\x09-\x0D]+$", "", text)
            fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[-1] not in ".!?" else ""
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            kinds.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        initials = [kind[0] for kind in kinds]
        cost, audit = step_by_step(kinds)
        left, lines, place = iter(said), [], 0
        for edit in audit:
            _, role, text = next(left) if edit != "I" else (None, "", "")
            if edit != "D":
                lines.append([edit, role, text])
        for place, line in enumerate(lines):
            if line[0] != "K":
                line[1] = ("user", "assistant")[(place - len(lines) % 2) % 2]
        results[conv_id] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *counts.values(),
                            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                            hashlib.sha256("\n".join(f"{role}:{text}" for _, role, text in lines).encode()).hexdigest())
    return results


@pytest.fixture(scope="module")
def rows(spark):
    dice = random.Random(3)
    texts = ["One. ", "Two!", "cut off", "", " \t\n", "é?", "And so on…", None, "a.\x0b"]
    found = [(dice.choice(texts) if dice.random() < 0.4 else f"text {conv} {turn}.", turn, conv,
              ("system" if not turn else "user" if turn % 2 else "assistant") if dice.random() < 0.8
              else dice.choice(["user", "assistant", "tool", None, ""]), 1, "x", 5)
             for conv in range(120) for turn in range(dice.randrange(9)) if dice.random() < 0.95]
    found += [("x.", None, 200, "user", None, None, None), ("y.", None, 200, "assistant", None, None, None)]
    found += [("n.", 3, None, "user", None, None, None), (None, 9, None, None, None, None, None)]
    # A third of all rows belong to one conversation, half of them alike.
    found += [(f"t {turn}." if turn % 2 else "Same.", turn, 999, ("user", "assistant")[turn % 2], 1, "x", 5) for turn in range(300)]
    return spark.createDataFrame(found, ROWS)


@pytest.mark.parametrize("most", [7, repair.SLICE])
def test_equal_to_a_plain_version(rows, most):
    found = repair.repaired(repair.damaged(rows), rows, most)
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {row.conv_id: tuple(row)[1:] for row in found.collect()} == expected(rows.collect())


def test_repaired_rows_are_good_conversations(spark, rows):
    damaged = repair.damaged(rows)
    found = repair.repaired(damaged, rows)
    repaired = repair.repaired_rows(damaged, found).where("conv_id is not null").sort("conv_id", "place").collect()
    for _, group in itertools.groupby(repaired, key=lambda row: row.conv_id):
        group = list(group)
        assert [row.place for row in group] == list(range(len(group)))
        assert GOOD.fullmatch("".join(row.role[0] for row in group))
        assert all(row.text == "" for row in group if row.edit == "I")


def test_empty_table(spark):
    nothing = spark.createDataFrame([], ROWS)
    assert repair.repaired(repair.damaged(nothing), nothing).collect() == []


def test_conversations_without_rows_after_the_damage(spark):
    turn = next(turn for turn in range(200) if zlib.crc32(f"1:{turn}".encode()) % 20 == 0)
    rows = spark.createDataFrame([("A.", turn, 1, "user", 1, "", 0)], ROWS)
    assert tuple(repair.repaired(repair.damaged(rows), rows).first()) == (1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
