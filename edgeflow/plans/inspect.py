"""Plan inspection."""


def plan_text(df, mode="formatted"):
    """The text `df.explain(mode)` prints."""
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)
