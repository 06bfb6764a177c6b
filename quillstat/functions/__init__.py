"""Column functions: money, calendar and labels. All built-in, no Python UDF."""
