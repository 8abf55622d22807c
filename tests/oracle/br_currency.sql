SELECT numverba,
       'R$ ' || replace(replace(replace(format('{:,.2f}', COALESCE(CAST(valor AS DOUBLE), 0.0)), ',', '#'), '.', ','), '#', '.') AS valor_fmt
FROM pcverba
