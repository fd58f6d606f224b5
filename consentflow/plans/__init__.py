"""Models (staging → mart → report) and analysis plans as DataFrame functions."""
