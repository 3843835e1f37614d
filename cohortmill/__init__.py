"""User value by channel, 36-month margin curves and ledger matching on Spark."""
