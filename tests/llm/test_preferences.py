from palimpsest.llm.preferences import mismatched_replies, preference_pairs

TURNS = "pair_id long, turn long, role string, text string, prompt string"


def pairs(spark, chosen, rejected):
    make = lambda rows: spark.createDataFrame([(*row, "clash") for row in rows], TURNS)
    return {r.pair_id: r for r in preference_pairs(make(chosen), make(rejected)).collect()}


def show(*turns):
    return "".join(f"<|{role}|>\n{text}<|end|>\n" for role, text in turns)


def test_common_prefix_is_rendered_once(spark):
    start = [(1, 0, "system", "be kind"), (1, 1, "user", "hi")]
    got = pairs(spark, start + [(1, 2, "assistant", "hello"), (1, 3, "user", "bye")],
                start + [(1, 2, "assistant", "go away")])[1]
    assert got.prompt_turns == 2 and got.usable
    assert got.prompt == show(("system", "be kind"), ("user", "hi"))
    assert got.chosen == show(("assistant", "hello"), ("user", "bye"))
    assert got.rejected == show(("assistant", "go away"))
    head, body = len("<|assistant|>\n"), len("hello<|end|>\n")
    assert got.chosen_mask == f"{head}:0,{body}:1,{len('<|user|>')+1}:0,{len('bye<|end|>')+1}:0"
    assert sum(int(x.split(":")[0]) for x in got.chosen_mask.split(",")) == len(got.chosen)


def test_defined_cases(spark):
    same = [(1, 0, "user", "a"), (1, 1, "assistant", "b")]
    got = pairs(spark, same + [(2, 0, "user", "only here"), (3, 0, "user", None), (3, 1, "assistant", "x"),
                               (None, 0, "user", "nobody"), (4, 5, "user", "late"), (4, 1, "user", "early"),
                               (4, 1, "user", "early")],
                same + [(3, 0, "user", None), (3, 1, None, "x"), (5, 0, "user", "<|end|>"),
                        (4, 1, "user", "early"), (4, 1, "user", "also")])
    assert set(got) == {1, 2, 3, 4, 5}
    assert got[1].prompt_turns == 2 and got[1].chosen == got[1].rejected == got[1].chosen_mask == "" and not got[1].usable
    assert got[2].prompt == got[2].rejected == "" and got[2].chosen == show(("user", "only here"))
    assert got[3].prompt == "<|user|>\n<|end|>\n" and got[3].rejected == "<||>\nx<|end|>\n"
    assert got[4].prompt_turns == 0 and got[4].chosen == show(("user", "early"), ("user", "late"))
    assert "<|end|><|end|>" not in got[5].rejected and got[5].rejected.count("<|end|>") == 1


def test_many_turns_and_no_turns(spark):
    long = [(1, at, "user" if at % 2 else "assistant", f"t{at}" * 20) for at in range(3000)]
    got = pairs(spark, long, long[:2999] + [(1, 2999, "user", "other")])[1]
    assert got.prompt_turns == 2999 and got.rejected == show(("user", "other"))
    assert pairs(spark, [], []) == {}


def test_mismatched_replies(spark):
    rows = [(0, 0, "user", "q0"), (0, 1, "assistant", "a0"), (1, 0, "user", "q1"), (1, 1, "assistant", "a1"),
            (1, 2, "user", "thanks"), (2, 0, "user", "q2"), (2, 1, "assistant", "a2"), (5, 0, "user", "no answer"),
            (None, 0, "user", "x")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.pair_id: r for r in preference_pairs(*mismatched_replies(frame)).collect()}
    assert got[0].prompt == show(("user", "q0")) and got[0].rejected == show(("assistant", "a1")) and got[0].usable
    assert got[1].chosen == show(("assistant", "a1"), ("user", "thanks"))
    assert got[2].rejected == "" and got[5].rejected == "" and not got[2].usable
