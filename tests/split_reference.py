"""Sizes of parts, class by class, with exact integers: what the table forms must equal."""

from math import ceil

def split_sizes(counts: dict, test_size: float) -> dict:
    """Rows per class for ``[test, train]``.

    The test part has ``ceil(test_size * n)`` rows.  The train rows are shared in
    proportion to the classes, the fractions going to the largest remainders, on
    a tie to the first class.
    """
    total = sum(counts.values())
    n_test = _ceil_share(total, test_size)
    n_train = total - n_test
    if min(n_test, n_train) < len(counts):
        raise ValueError(f"{n_test} test and {n_train} train rows cannot hold {len(counts)} classes")
    train = _proportional(counts, n_train)
    return {c: [n - train[c], train[c]] for c, n in counts.items()}


def _ceil_share(total: int, share: float) -> int:
    if not 0 < share < 1:
        raise ValueError(f"the test share must be between 0 and 1, not {share}")
    return ceil(share * total)


def _proportional(counts: dict, wanted: int) -> dict:
    total = sum(counts.values())
    floors = {c: n * wanted // total for c, n in counts.items()}
    left = wanted - sum(floors.values())
    by_remainder = sorted(counts, key=lambda c: (-(counts[c] * wanted % total), _sort_key(c)))
    for c in by_remainder[:left]:
        floors[c] += 1
    return floors


def fold_sizes(counts: dict, folds: int) -> dict:
    """Rows per class and fold: classes are dealt to the folds one after another.

    The deal goes on with the next fold where the class before ended, so the
    folds differ by at most one row in each class and in total.
    """
    if max(counts.values()) < folds:
        raise ValueError(f"no class has {folds} rows")
    sizes, start = {}, 0
    for c in sorted(counts, key=_sort_key):
        end = start + counts[c]
        sizes[c] = [(end + folds - 1 - i) // folds - (start + folds - 1 - i) // folds for i in range(folds)]
        start = end
    return sizes


def _sort_key(value: object) -> tuple:
    return (value is None, value if value is not None else 0)


