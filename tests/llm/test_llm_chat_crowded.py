"""Many messages at few turn numbers: rows stay bounded, in order and whole."""

from aerolith.llm import chat


def test_crowded_turns_are_cut_by_messages(spark):
    crowd = [(None, t, "u", f"m{i:03d}") for t in (0, 1) for i in range(25)] + [(None, None, "a", f"n{i}") for i in range(9)]
    calm = [(7, i, "u", str(i)) for i in range(10)]
    schema = "conv_id long, turn long, role string, text string"
    frame = spark.createDataFrame(crowd + crowd[:5] + calm, schema).repartition(5)
    out = chat.collapse_snapshots(frame, turns_per_row=4).collect()
    mine = sorted((r for r in out if r["conv_id"] is None), key=lambda r: r["segment"])
    assert [r["segment"] for r in mine] == list(range(15)) and {r["n_messages"] for r in mine} == {59}
    assert all(r["text"].count(chat.OPEN) <= 4 for r in mine)
    ordered = sorted(crowd, key=lambda m: (m[1] is not None, m[1] or 0, m[2], m[3]))
    said = lambda m: f"{chat.OPEN}{m[2]}{chat.MIDDLE}{m[3]}{chat.CLOSE}"
    assert "".join(r["text"] for r in mine) == "".join(map(said, ordered))
    assert sorted(r["segment"] for r in out if r["conv_id"] == 7) == [0, 1, 2]
