"""The automaton decides a word as soon as nothing can follow."""

from tallyforge.llm import toxicity


def test_automaton_works_out_a_verdict_once_a_state():
    automaton = toxicity.Automaton(["worthless", "idiot"], ["scum"])
    assert [automaton.match(w) for w in ("worthless", "worhtless", "wrthles", "idiots", "scumbag", "scu", "zebra", "")] == [0, 1, 2, 1, 0, -1, -1, -1]
    states = len(automaton.states)
    assert len(automaton.ended) == states == len(automaton.moves)
    assert {to for moves in automaton.moves for to in moves.values() if to < 0} == {toxicity.DEAD, toxicity.STEM}
    automaton.match("scumscumscum"), automaton.match("zzzzzzzz")  # decided in known states
    assert len(automaton.states) == states
