"""Column functions: null defaults, blank tests, business expressions, date windows."""
