"""Column expressions: conversion, text rules, keys and clustering values."""
