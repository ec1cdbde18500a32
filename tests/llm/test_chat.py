"""Rotated dialogues against a plain rendering."""

import pytest

from tripworks.llm import chat
from tripworks.llm.frames import prepare

SCHEMA = "conv_id bigint, turn bigint, role string, text string, speaker string, part int, place int"


def brute(rows, part_turns=chat.PART_TURNS):
    """{(conv, part, speaker): (text, where it begins, mask)}"""
    safe = lambda t: t.replace("<|", "< |").replace("|>", "| >")
    talks = {}
    for conv, turn, role, text in rows:
        talks.setdefault(conv, []).append((turn is not None, turn or 0, role or "unknown", text or ""))
    out = {}
    for conv, turns in talks.items():
        turns.sort()
        for speaker in {r for _, _, r, _ in turns} - {"system"}:
            done = 0
            for start in range(0, len(turns), part_turns):
                whole, mask = "", []
                for _, _, role, text in turns[start : start + part_turns]:
                    head = "assistant" if role == speaker else safe(role) if role == "system" else f"user:{safe(role)}"
                    whole += f"<|{head}|>\n"
                    body = safe(text) + "<|end|>"
                    if role == speaker:
                        mask.append(f"{done + len(whole)}:{done + len(whole) + len(body)}")
                    whole += body + "\n"
                out[conv, start // part_turns, speaker] = (whole, done, ",".join(mask))
                done += len(whole)
    return out


ROWS = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hi <|assistant|> there"), (1, 2, "assistant", "Hello 😀"), (1, 3, "user", ""), (1, 4, "Zoë", None),
    (2, 0, "user", "alone"), (3, 0, "system", "nobody"), (4, None, None, "x"), (4, 1, "a", "y"), (4, 1, "a", "y"), (4, 1, "a", "b"), (4, None, "|>a", "z"),
    (None, 0, "user", "lost"), (None, 1, "other", "found"), (5, 2, "user", "late"), (5, 1, "assistant", "early " * 20_000),
]


@pytest.mark.parametrize("part_turns", [1, 2, 256])
def test_every_participant_is_the_assistant_once(spark, part_turns):
    prepare(spark)
    rows = ROWS + [(6, t, f"p{t % 3}", f"word {t}") for t in range(700)]
    df = spark.createDataFrame([(*r, "s", 1, 2) for r in rows], SCHEMA).repartition(4)
    found = chat.rotate(df, part_turns=part_turns).collect()
    expected = brute(rows, part_turns)
    assert {(r["conv_id"], r["part"], r["speaker"]): (r["text"], r["offset"], r["mask"]) for r in found} == expected
    assert len(found) == len(expected)
    for r in found:
        spans = [tuple(map(int, s.split(":"))) for s in r["mask"].split(",") if s]
        assert r["n_chars"] == len(r["text"]) and r["n_trained"] == sum(b - a for a, b in spans)
        assert r["n_turns"] == r["text"].count("<|end|>\n") and len(spans) == r["text"].count("<|assistant|>\n")
        assert all(r["text"][a - r["offset"] : b - r["offset"]].endswith("<|end|>") for a, b in spans)


def test_parts_of_a_speaker_make_up_the_whole_dialogue(spark):
    prepare(spark)
    rows = [(1, 0, "system", "Be kind.")] + [(1, t, f"p{t % 2}", f"word {t}") for t in range(1, 40)]
    df = spark.createDataFrame([(*r, "s", 1, 2) for r in rows], SCHEMA)
    whole = {r["speaker"]: r for r in chat.rotate(df).collect()}
    parts = chat.rotate(df, part_turns=7).orderBy("part").collect()
    for speaker, r in whole.items():
        own = [p for p in parts if p["speaker"] == speaker]
        assert len(own) == 6 and "".join(p["text"] for p in own) == r["text"] and r["text"].count("<|system|>") == 1
        assert ",".join(p["mask"] for p in own if p["mask"]) == r["mask"]


def test_empty_table(spark):
    assert chat.rotate(spark.createDataFrame([], SCHEMA)).count() == 0
