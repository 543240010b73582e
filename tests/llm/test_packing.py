"""The packing rule against a plain search over all sequences."""

import numpy as np

from statweave.llm import packing


def plain(lengths, capacities):
    room, cost, out = list(capacities), [0.0] * len(capacities), []
    todo = [(n, -i, 0) for i, n in enumerate(lengths) if n]
    while todo:
        n, i, start = piece = max(todo)
        todo.remove(piece)
        fit = [s for s, r in enumerate(room) if r >= n]
        s = min(fit, key=lambda s: (cost[s], s)) if fit else max(range(len(room)), key=lambda s: (room[s], -s))
        take = min(n, room[s])
        out.append((-i, start, take, s, capacities[s] - room[s]))
        room[s] -= take
        cost[s] += packing.attention_cost(take)
        if take < n:
            todo.append((n - take, i, start + take))
    return out


def test_cut_only_where_no_sequence_has_room():
    rng = np.random.default_rng(3)
    lengths = [int(min(max(x, 1), 1023)) for x in rng.lognormal(5, 1.2, 1500)]
    caps, _ = packing.power_capacities(sum(lengths), 1024, True)
    assert packing.assign(lengths, caps) == plain(lengths, caps)


def test_few_and_odd_sequences():
    for lengths, caps in [([], []), ([0], []), ([5], [4, 1]), ([3, 3, 2], [8]), ([1] * 7, [4, 2, 1])]:
        assert packing.assign(lengths, caps) == plain(lengths, caps)
