"""The lock-step fold equals the fold of one run after another."""

import random

import numpy as np

from wakeline.operators.speed import fold_lock_step, fold_positions


def test_lock_step_equals_single_folds():
    rnd = random.Random(12)
    for _ in range(200):
        times, first, count, orders, want = [], [], [], [], []
        for _ in range(rnd.randint(1, 9)):
            begin, old, new = len(times), rnd.randint(0, 6), rnd.choice([0, 1, 5, 30])
            t = 100.0
            for _ in range(old + new):
                t += rnd.choice([0.0, 0.4, 0.4, 1.0, 3.0, 6.0])
                times.append(float("nan") if rnd.random() < 0.02 else t)
            order = list(range(begin, begin + old))
            rnd.shuffle(order)
            first.append(begin + old)
            count.append(new)
            orders.append(np.array(order, dtype=np.int64))
        every = np.array(times)
        base, after = fold_lock_step(every, np.array(first), np.array(count), orders, 5.0)
        for f, n, o, a in zip(first, count, orders, after):
            b, end = fold_positions(every[:f + n], f, o, 5.0)
            assert base[f:f + n].tolist() == b.tolist()
            assert a.tolist() == end.tolist()


def test_lock_step_of_nothing():
    base, after = fold_lock_step(np.empty(0), np.empty(0, np.int64), np.empty(0, np.int64), [], 5.0)
    assert len(base) == 0 and after == []
