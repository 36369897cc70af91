"""The three jobs: formatting, indicators, price model."""
