import pytest

from ledgerlake import operators as op

NAN = float("nan")


def labels(df):
    return [r.balance_check for r in op.flag_balance(df).collect()]


@pytest.mark.parametrize(
    "type, rate, label",
    [
        ("PAYMENT", 0.01, "payment_fee_exceeded"),
        ("TRANSFER", 0.02, "transfer_fee_exceeded"),
        ("CASH_OUT", 0.03, "cashout_fee_exceeded"),
    ],
)
def test_rule_applies_above_its_rate_in_both_directions(frame, type, rate, label):
    def drifted(share):
        return (type, 1000.0, 5000.0, 5000.0 - 1000.0 - 1000.0 * share)

    df = frame(drifted(rate - 0.001), drifted(rate + 0.001), drifted(0.001 - rate), drifted(-rate - 0.001))
    assert labels(df) == ["valid", label, "valid", label]


def test_exact_threshold_is_valid(frame):
    # 0.03 * 100 and 200 - 100 - 97 are both exactly 3 in doubles.
    assert labels(frame(("CASH_OUT", 100.0, 200.0, 97.0))) == ["valid"]


def test_types_without_rule_are_valid(frame):
    df = frame(*((t, 100.0, 200.0, 0.0) for t in ("CASH_IN", "DEBIT", "REFUND", "payment", None)))
    assert labels(df) == ["valid"] * 5


def test_null_is_valid_and_nan_is_flagged(frame):
    df = frame(
        ("PAYMENT", None, 200.0, 0.0),
        ("PAYMENT", 100.0, None, 0.0),
        ("PAYMENT", 100.0, 200.0, None),
        ("PAYMENT", 100.0, NAN, 0.0),
    )
    assert labels(df) == ["valid", "valid", "valid", "payment_fee_exceeded"]


def test_zero_and_negative_amounts(frame):
    df = frame(
        ("PAYMENT", 0.0, 200.0, 200.0),
        ("PAYMENT", 0.0, 200.0, 199.0),
        ("PAYMENT", -50.0, 200.0, 250.0),
    )
    assert labels(df) == ["valid", "payment_fee_exceeded", "payment_fee_exceeded"]


def test_discrepancies_are_counted_per_type_and_label(frame):
    bad = ("PAYMENT", 64.0, 90.0, 13.0)
    df = frame(bad, bad, ("TRANSFER", 64.0, 90.0, 13.0), ("DEBIT", 64.0, 90.0, 13.0))
    got = {tuple(r) for r in op.balance_discrepancies(df).collect()}
    assert got == {("PAYMENT", "payment_fee_exceeded", 2), ("TRANSFER", "transfer_fee_exceeded", 1)}


def consistency(df):
    return tuple(op.balance_consistency(df).first())


def test_balance_consistency(frame):
    good, bad = ("PAYMENT", 7.25, 20.0, 12.75), ("PAYMENT", 7.25, 20.0, 11.0)
    assert consistency(frame(good)) == (1, 0, True)
    assert consistency(frame(bad)) == (1, 1, False)
    # Every row counts, whichever comes first.
    assert consistency(frame(good, bad)) == consistency(frame(bad, good)) == (2, 1, False)
    assert consistency(frame(("PAYMENT", 7.25, 20.0, 12.759))) == (1, 0, True)


def test_balance_consistency_without_payments_or_operands(frame):
    assert consistency(frame(("DEBIT", 64.0, 90.0, 13.0))) == (0, 0, True)
    assert consistency(frame(("PAYMENT", None, 90.0, 13.0))) == (1, 1, False)
    assert consistency(frame(("PAYMENT", NAN, 90.0, 13.0))) == (1, 1, False)
