"""Spark-native analytics for ultrasonic tube-inspection scans."""
