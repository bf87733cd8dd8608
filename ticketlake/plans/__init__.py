"""Composed jobs: silver and gold loads, and the registered queries with their SQL oracles."""
