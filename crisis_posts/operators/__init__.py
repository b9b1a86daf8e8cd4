"""DataFrame to DataFrame steps. None creates a session or collects its input."""
