"""A suffix automaton of word sequences, and matching statistics against it."""

from __future__ import annotations

from itertools import count


class SuffixAutomaton:
    """The automaton of several sequences, each with a weight; a state knows the weight of its occurrences.

    Sequences are joined by separators that occur once, so no match crosses them.
    """

    def __init__(self, sequences: list[list], weights: list[int]):
        length, link, step, weight = [0], [-1], [{}], [0]
        last, separators = 0, count()
        for sequence, w in zip(sequences, weights):
            for token in [*sequence, ("end", next(separators))]:
                new = len(length)
                length.append(length[last] + 1)
                link.append(0)
                step.append({})
                weight.append(w)
                at = last
                while at >= 0 and token not in step[at]:
                    step[at][token] = new
                    at = link[at]
                if at >= 0:
                    to = step[at][token]
                    if length[at] + 1 == length[to]:
                        link[new] = to
                    else:
                        clone = len(length)
                        length.append(length[at] + 1)
                        link.append(link[to])
                        step.append(dict(step[to]))
                        weight.append(0)
                        link[to] = link[new] = clone
                        while at >= 0 and step[at].get(token) == to:
                            step[at][token] = clone
                            at = link[at]
                last = new
        # Longest first: every state hands its occurrences on to the suffix it links to.
        for state in sorted(range(1, len(length)), key=length.__getitem__, reverse=True):
            weight[link[state]] += weight[state]
        self.length, self.link, self.step, self.weight = length, link, step, weight

    def repeated_spans(self, sequence: list, least: int) -> list[tuple[int, int]]:
        """Maximal spans (begin, end) of the sequence that are covered by runs of at least `least` tokens of weight 2
        or more in the automaton."""
        length, link, step, weight = self.length, self.link, self.step, self.weight
        spans: list[tuple[int, int]] = []
        state = matched = 0
        for i, token in enumerate(sequence):
            while True:
                to = step[state].get(token)
                if to is not None and weight[to] >= 2:
                    state, matched = to, matched + 1
                    break
                if state == 0:
                    matched = 0
                    break
                state = link[state]
                matched = length[state]
            if matched >= least:
                begin = i + 1 - matched
                if spans and begin <= spans[-1][1]:
                    spans[-1] = (min(begin, spans[-1][0]), i + 1)
                else:
                    spans.append((begin, i + 1))
        return spans
