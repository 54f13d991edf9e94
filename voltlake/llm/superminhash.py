"""SuperMinHash signatures of many sets at once, in numpy.

Each element of a set gets one pseudo-random permutation of the m slots, revealed one step at a
time: in step j it offers the value ``j + u`` (u uniform in [0, 1)) to the slot at place j of its
permutation. A slot keeps the smallest offer. Two properties follow: the values of one element are
spread over all slots (which makes the estimate of the Jaccard similarity vary less than with
independent hash functions), and a set is finished as soon as every slot holds a value below the
next step's number, so that sets much larger than m need one or two steps.

Here all elements of a batch of sets take step j together; sets that are finished drop out.
The permutation is never stored whole: an element's place j is found from the swaps of its
earlier steps.
"""

from __future__ import annotations

import numpy as np

_U64 = np.uint64
STEP_SHIFT = 40  # a value is the step above these bits and the random part below


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the splitmix64 finaliser)."""
    with np.errstate(over="ignore"):
        x = x + _U64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def signatures(elements: np.ndarray, owner: np.ndarray, sets: int, slots: int) -> np.ndarray:
    """Signatures, one row of ``slots`` 64-bit values per set; equal values mean a collision.

    ``elements`` are 64-bit hashes, distinct within a set; ``owner`` is the set of each element.
    An empty set gets a row of the largest value. The low bits of a value are those of its random
    part, so that values of different steps or elements practically never coincide.
    """
    best = np.full((sets, slots), np.iinfo(np.uint64).max, dtype=np.uint64)
    flat, base = best.reshape(-1), owner.astype(np.int64) * slots
    who, state = owner, mix64(elements.astype(np.uint64))
    swaps: list[np.ndarray] = []
    low = _U64((1 << STEP_SHIFT) - 1)
    for step in range(slots):
        if not len(who):
            break
        with np.errstate(over="ignore"):
            drawn = mix64(state + _U64(step) * _U64(0xD1342543DE82EF95))
        # The upper bits choose the place, the lower ones the value.
        other = step + ((drawn >> _U64(STEP_SHIFT)) * _U64(slots - step) >> _U64(64 - STEP_SHIFT)).astype(np.int64)
        place = other.copy()
        for earlier in range(step - 1, -1, -1):
            place[swaps[earlier] == place] = earlier
        swaps.append(other)  # what stood at place `step` has moved to place `other`
        np.minimum.at(flat, base + place, _U64(step << STEP_SHIFT) | (drawn & low))
        unfinished = best.max(axis=1) >> _U64(STEP_SHIFT) > step
        more = unfinished[who]
        if not more.all():
            who, state, base = who[more], state[more], base[more]
            swaps = [taken[more] for taken in swaps]
    return best
