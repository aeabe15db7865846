"""Operators: DataFrame to DataFrame, nothing runs before an action unless said."""
