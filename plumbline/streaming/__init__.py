"""Event contract, stream routing and stream alerts."""
