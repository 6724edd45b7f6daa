"""DataFrame-to-DataFrame operators and the sinks they end in."""
