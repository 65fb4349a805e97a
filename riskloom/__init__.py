"""Event-window risk engine on PySpark: clean, replay, window, score and report."""
