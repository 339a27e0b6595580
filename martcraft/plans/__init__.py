"""Views and marts: pure DataFrame builders."""
