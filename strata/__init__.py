"""Layered (raw, typed, star schema) payroll analytics as plain DataFrame operators."""
