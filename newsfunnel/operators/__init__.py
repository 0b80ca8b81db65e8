"""DataFrame -> DataFrame operators of the funnel."""
