"""DataFrame-to-DataFrame operators.

They stay lazy, with two named exceptions that must measure before they go on:
``contracts.fail_on_nulls`` (gate) and ``layout.compact_table``.
"""
