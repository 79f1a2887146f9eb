"""DataFrame -> DataFrame operators (risk, staging, stress, reports, capital, back-test, catalogue)."""
