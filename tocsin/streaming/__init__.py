"""The quarter rollup kept up to date from event files as they arrive."""
