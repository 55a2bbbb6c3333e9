"""The 99-month series (2022-01 … 2030-03) and the recorded
outputs of one forecasting run, used as golden checks."""

SOLAR_START = "2022-01-01"
SOLAR_VALUES = [
    123.4, 125.9, 130.2, 128.5, 132.0, 135.7, 140.1, 145.3, 150.0, 155.2,
    160.5, 165.0, 170.3, 175.6, 180.1, 185.4, 190.0, 195.5, 200.2, 205.8,
    210.0, 215.3, 220.7, 225.0, 230.4, 235.6, 240.1, 245.3, 250.0, 255.5,
    260.2, 265.8, 270.0, 275.3, 280.7, 285.0, 290.4, 295.6, 300.1, 305.3,
    310.0, 315.5, 320.2, 325.8, 330.0, 335.3, 340.7, 345.0, 350.4, 355.6,
    360.1, 365.3, 370.0, 375.5, 380.2, 385.8, 390.0, 395.3, 400.7, 405.0,
    410.4, 415.6, 420.1, 425.3, 430.0, 435.5, 440.2, 445.8, 450.0, 455.3,
    460.7, 465.0, 470.4, 475.6, 480.1, 485.3, 490.0, 495.5, 500.2, 505.8,
    510.0, 515.3, 520.7, 525.0, 530.4, 535.6, 540.1, 545.3, 550.0, 555.5,
    560.2, 565.8, 570.0, 575.3, 580.7, 585.0, 590.4, 595.6, 600.1,
]

# recorded results for this series
ADF_P_RAW = 0.9770786655106863
ADF_P_AFTER = 4.960054012897482e-18
AR_S_L12_CSS = 0.7931097  # least squares on lags 12, 24 of the twice-differenced log series
AR_S_L24_CSS = 0.0209319
FORECAST_FIRST = 605.2343776255577
FORECAST_LAST = 649.8557941964640
LJUNG_BOX_Q = 32.33653453589718
LJUNG_BOX_P = 0.028632804576371934
