"""Spark-native operators that turn noisy, reposted listings into one clean record per opening."""
