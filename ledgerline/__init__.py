"""Loan-ledger and meter-series analytics as lazy Spark DataFrame operators."""
